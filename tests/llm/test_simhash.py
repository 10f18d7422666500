"""Fingerprints, links and classes against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from gridsight.llm import graph, simhash
from tests.llm.helpers import empty, hard, hard_rows, prose


def brute_print(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints: dict[int, int]) -> dict[int, int]:
    """Least key reachable over links of at most three bits."""
    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    root = list(range(len(keys)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return {k: keys[find(i)] for i, k in enumerate(keys)}


def _flip(value: int, bits: list[int]) -> int:
    for b in bits:
        value ^= 1 << b
    return value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_against_brute_force():
    draw = random.Random(1)
    texts = [None, "", " \n ", "One", "one TWO", "É É É é", prose(3, 500), "a b c " * 50, prose(9, 70000)] + ["".join(draw.choices("ab A\n\t\x0bé\x85\xa0", k=30)) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint_of(None if t is None else t.encode()) % (1 << 64) == brute_print(t)


@pytest.mark.parametrize(("crowded", "dense"), [(1, 0), (3, simhash.DENSE), (64, 5), (10**9, 0)])
def test_links_against_brute_force(spark, crowded, dense):
    """Random fingerprints, chains of three-bit steps, clouds around a centre, in every half."""
    draw = random.Random(crowded + dense)
    prints, key = {}, 0
    values = [draw.getrandbits(64) for _ in range(150)] + [0, (1 << 64) - 1]
    for _ in range(6):
        at = draw.getrandbits(64)
        for _ in range(8):
            at = _flip(at, draw.sample(range(64), 3))
            values.append(at)
    for halves in ((0, 32), (32, 64), (0, 64)):
        centre = draw.getrandbits(64)
        for _ in range(60):
            values.append(_flip(centre, draw.sample(range(*halves), draw.randint(0, 5))))
    values += values[:20]
    draw.shuffle(values)
    for v in values:
        prints[key] = v
        key += 1
    frame = spark.createDataFrame([(k, _signed(v)) for k, v in prints.items()], "doc_id long, fp long")
    classes = {r["fp"]: r["component_id"] for r in simhash.classes(frame, crowded=crowded, dense=dense).collect()}
    want = brute_classes(prints)
    assert {k: classes[_signed(v)] for k, v in prints.items()} == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 5), (200, 201), (201, 202), (202, 200), (7, 7)] + [(300, k) for k in range(301, 330)]
    got = {r["v"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in [*range(61), 100]} | {200: 200, 201: 200, 202: 200} | {k: 300 for k in range(300, 330)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_survives_hard_rows(spark):
    got = simhash.near_duplicates(hard(spark)).select("doc_id", "fp", "component_id").collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in hard_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["component_id"] == by_id[1]["component_id"] == by_id[2]["component_id"] == 0
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == 5
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_keep_one_of_each_class(spark):
    docs = hard(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 5 in ids and 6 not in ids and None not in ids
    assert simhash.keep_one(empty(spark)).count() == 0


def test_null_id_alone_is_kept(spark):
    docs = spark.createDataFrame([(None, prose(1, 50)), (None, prose(1, 50)), (3, prose(2, 50))], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 2
