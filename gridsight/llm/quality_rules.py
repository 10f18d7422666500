"""Adaptive quality rules from mergeable quantile sketches.

Every text gets a handful of integer statistics. Per (lang, source), per lang and
over all, each measure's distribution among the texts that pass the base rules is
kept as a log-linear histogram: a quantile sketch whose merge is the sum of
counts, with a relative error of at most 1/32. Fences come from the sketches
alone: q85 + 3 (q85 - q50) upwards and, for the length of words, q15 - 3 (q50 - q15)
downwards, so up to 15 % of junk on a side does not move its fence. No measure has
a cutoff of its own. A group's quantiles are shrunk to its language's, and those to
the whole corpus's, with the weight of ``PRIOR_ROWS`` rows.

A rate counted on few words or lines moves in steps, so ``EVENTS`` single events (a
sign, a line, a passage said twice, a word without length or twice as long) are taken
off a text's count before its rate is held against the fence; in a long text they
weigh nothing.

All of it is built-in column expressions. Sketches are summed before they are
shuffled; the fences are joined back on (lang, source) and Spark broadcasts them
only if their measured size allows, otherwise it sorts and splits skewed keys.

Defined results: a null text counts as empty (no words, base_failed); null lang
or source form groups of their own; a group without a text that passes the base
rules has no fences and none of its texts is kept; ties lie inside a fence;
repeated rows are judged one by one; an empty table gives an empty result; input
columns of any name are kept apart from the statistics, which live in one struct
column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
UPPER = "[A-Z]"
SPAN = 8
#: Rates in parts of 10,000 by what is counted, out of what, and how much of it one event adds (a passage said twice is two windows).
RATES = {"symbol": ("n_symbols", "word_chars", 1), "upper": ("n_upper", "word_chars", 1), "dup_line": ("n_dup_lines", "n_lines", 1), "repeat": ("n_repeat_words", "n_words", 2 * SPAN)}
#: The measure with a fence on either side: characters of a word, in hundredths.
WORD_LENGTH = "word_length"
#: Percentiles of the sketches; how often their range lies between the outer one and the fence; rows a parent's quantiles weigh; single events that are no evidence of a rate.
QUANTILES, REACH, PRIOR_ROWS, EVENTS = (15, 50, 85), 3, 100, 3
#: Sub-buckets of an octave in the sketch are 32, so a bin's edges are within 1/32.
SUB_BITS = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words between blanks; single-character splits avoid the regular-expression engine."""
    plain = F.coalesce(text, F.lit(""))
    for blank in SPACE[1:]:
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def _count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _each(count: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), count - 1), body)


def _covered(words: Column) -> Column:
    """Words inside 8-word windows that occur at least twice.

    Elements are read one by one: slicing inside a lambda would copy the whole
    array for every window.
    """
    windows = F.size(words) - (SPAN - 1)

    def window(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i + j) for j in range(SPAN)])

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(SPAN), F.coalesce(F.get(at, k + 1) - p, F.lit(SPAN))).cast("long")),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )

    def starts(ws: Column, same: Callable[[Column, Column], Column]) -> Column:
        """Places of the members of ``ws`` (sorted, with their places ``p``) that are the same as a neighbour."""
        either = lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(ws) - 1), either), lambda k: F.get(ws, k)["p"]))

    def exact() -> Column:
        texts = F.sort_array(_each(windows, lambda i: F.struct(window(i).alias("w"), i.alias("p"))))
        return let(let(texts, lambda ws: starts(ws, lambda k, other: F.get(ws, k)["w"] == F.get(ws, other)["w"])), covered)

    def repeated(h: Column) -> Column:
        """Only windows of equal hashes are told apart by their texts, and those one by one: a long text's windows all at once would fill the heap."""

        def judged(hs: Column) -> Column:
            same = lambda k, other: F.get(hs, k)["h"] == F.get(hs, other)["h"]
            mixed = F.exists(F.sequence(F.lit(0), F.size(hs) - 1), lambda k: F.coalesce(same(k, k + 1) & (window(F.get(hs, k)["p"]) != window(F.get(hs, k + 1)["p"])), F.lit(False)))
            return F.when(mixed, exact()).otherwise(let(starts(hs, same), covered))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), judged)

    # In one step: hashes of halves and quarters of a window would stay in memory as well.
    hashes = _each(windows, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SPAN)]))
    # Windows with pairwise different hashes are all different, so sorting is left to the others.
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(repeated(h)))
    return F.when(windows < 1, F.lit(0).cast("long")).otherwise(some)


def statistics(text: Column) -> Column:
    """The struct of integer statistics of a whole text."""
    full = F.coalesce(text, F.lit(""))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"), _covered(words).alias("n_repeat_words")
        )

    lines = let(F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines)
    words = let(words_of(text), of_words)
    return let(
        F.struct(words.alias("w"), lines.alias("l")),
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"),
            s["w"]["word_chars"].alias("word_chars"),
            _count_of(full, SYMBOLS).alias("n_symbols"),
            s["l"]["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"),
            s["l"]["n_lines"].alias("n_lines"),
            _count_of(full, UPPER).alias("n_upper"),
        ),
    )


def measures(s: Column) -> dict[str, Column]:
    """What the sketches hold of a text: rates in parts of 10,000, and the mean length of its words in hundredths."""

    def per(part: Column, by: int, whole: Column) -> Column:
        return F.floor(part * by / F.greatest(whole, F.lit(1))).cast("long")

    return {name: per(s[part], 10000, s[whole]) for name, (part, whole, _) in RATES.items()} | {WORD_LENGTH: per(s["word_chars"], 100, s["n_words"])}


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def bin_floor(value: Column) -> Column:
    """Lower edge of a value's sketch bin: its top six binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - F.lit(SUB_BITS + 1), F.lit(0))
    return let(drop, lambda d: F.call_function("shiftleft", F.call_function("shiftright", value, d), d)).cast("long")


def sketches(stats: DataFrame) -> DataFrame:
    """``lang, source, metric, bin, n``: the sketches of ``stats (lang, source, s)``; summing ``n`` over groups merges them."""
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), bin_floor(v).alias("bin")) for k, v in measures(F.col("s")).items()])
    passed = stats.filter(~base_failed(F.col("s"))).select("lang", "source", F.explode(pairs).alias("p"))
    return passed.groupBy("lang", "source", "p.metric", "p.bin").agg(F.count(F.lit(1)).alias("n"))


def _quantiles(sketch: DataFrame, *level: str) -> DataFrame:
    """``*level, metric, rows, q15, q50, q85`` of the sketches merged to a level; bins of a group are bounded in number."""
    merged = sketch.groupBy(*level, "metric", "bin").agg(F.sum("n").alias("n")).groupBy(*level, "metric").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("rows"))

    def at(q: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
        step = lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["at"].isNull() & ((a["seen"] + x["n"]) * 100 >= F.col("rows") * q), x["bin"]).otherwise(a["at"]).alias("at"))
        return F.aggregate("bins", start, step)["at"]

    return merged.select(*level, "metric", "rows", *[at(q).alias(f"q{q}") for q in QUANTILES])


def fences(sketch: DataFrame) -> DataFrame:
    """``f_lang, f_source, low, high``: a map from metric to fence for every (lang, source) in the sketches."""
    own, wide, whole = (_quantiles(sketch, *level).alias(name) for name, level in (("o", ("lang", "source")), ("w", ("lang",)), ("c", ())))
    met = own.join(wide, F.col("o.lang").eqNullSafe(F.col("w.lang")) & (F.col("o.metric") == F.col("w.metric"))).join(whole, F.col("o.metric") == F.col("c.metric"))

    def shrunk(level: str, name: str, parent: Column) -> Column:
        rows = F.col(f"{level}.rows")
        return F.call_function("div", rows * F.col(f"{level}.{name}") + PRIOR_ROWS * parent, rows + PRIOR_ROWS)

    least, middle, most = names = [f"q{q}" for q in QUANTILES]
    found = met.select("o.lang", "o.source", "o.metric", *[shrunk("o", q, shrunk("w", q, F.col(f"c.{q}"))).alias(q) for q in names])
    low = F.col(least) - REACH * (F.col(middle) - F.col(least))
    # A quantile is its bin's lower edge; a 32nd more is the upper one.
    high = F.col(most) + F.call_function("div", F.col(most), F.lit(1 << SUB_BITS)) + REACH * (F.col(most) - F.col(middle))
    listed = found.groupBy("lang", "source").agg(F.collect_list(F.struct("metric", low.alias("low"), high.alias("high"))).alias("f"))
    return listed.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[F.map_from_arrays(F.col("f")["metric"], F.col("f")[side]).alias(side) for side in ("low", "high")])


def inside(s: Column) -> Column:
    """Whether a text's measures lie within the fences of its row (columns ``low`` and ``high``); null without fences."""
    length = s["word_chars"] * 100
    found = (length >= F.col("low")[WORD_LENGTH] * (s["n_words"] - EVENTS)) & (length <= F.col("high")[WORD_LENGTH] * (s["n_words"] + EVENTS))
    for name, (part, whole, event) in RATES.items():
        found = found & ((s[part] - EVENTS * event) * 10000 <= F.col("high")[name] * s[whole])
    return found


def judge(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (struct of the kept input columns), ``s`` (statistics), ``base_failed`` and ``kept``.

    ``keep`` names the input columns to carry (all by default). The statistics are
    computed once and stored, as they feed both the sketches and the filter.
    """
    carried = docs.columns if keep is None else keep
    stored = scratch.table(
        docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), docs[lang].alias("lang"), docs[source].alias("source"), statistics(docs[text]).alias("s")),
        "quality-rules",
    )
    # A stored table has a known size, so a small one is broadcast before any text is shuffled.
    bounds = scratch.table(fences(scratch.table(sketches(stored), "sketches")), "fences")
    joined = stored.join(bounds, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    failed = base_failed(F.col("s"))
    return joined.select("row", "s", failed.alias("base_failed"), (~failed & F.coalesce(inside(F.col("s")), F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns."""
    return judge(docs, **options).filter("kept").select("row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs, keep=["doc_id"]).select(
        "row.doc_id", *[F.col("s")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept"
    )


def judged_sql(docs: str = "documents") -> str:
    """DuckDB text of ``judge``: common table expressions ending in ``qr_judged``."""
    ws = "[\\x20\\x09-\\x0D]"
    rates = {name: f"{part} * 10000 // greatest({whole}, 1)" for name, (part, whole, _) in RATES.items()} | {WORD_LENGTH: "word_chars * 100 // greatest(n_words, 1)"}
    long = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, {v} AS v FROM qr_stats WHERE NOT base_failed" for k, v in rates.items())

    def level(name: str, keys: str) -> str:
        by = f"{keys}, metric" if keys else "metric"
        return f"""qr_c_{name} AS (SELECT {by}, bin, sum(n) AS n FROM qr_bins GROUP BY {by}, bin),
        qr_r_{name} AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS seen, sum(n) OVER (PARTITION BY {by}) AS total FROM qr_c_{name}),
        qr_q_{name} AS (SELECT {by}, max(total)::BIGINT AS n, {", ".join(f"min(bin) FILTER (WHERE seen * 100 >= total * {q}) AS q{q}" for q in QUANTILES)} FROM qr_r_{name} GROUP BY {by})"""

    def shrunk(level: str, name: str, parent: str) -> str:
        return f"(({level}.n * {level}.{name} + {PRIOR_ROWS} * {parent}) // ({level}.n + {PRIOR_ROWS}))"

    least, middle, most = names = [f"q{q}" for q in QUANTILES]
    quantiles = ", ".join(f"{shrunk('o', q, shrunk('w', q, f'c.{q}'))} AS {q}" for q in names)
    sides = ", ".join(f"max(high) FILTER (WHERE metric = '{m}') AS h_{m}" for m in rates) + f", max(low) FILTER (WHERE metric = '{WORD_LENGTH}') AS l_{WORD_LENGTH}"
    verdict = " AND ".join([f"({part} - {EVENTS * event}) * 10000 <= h_{name} * {whole}" for name, (part, whole, event) in RATES.items()] + [f"word_chars * 100 BETWEEN l_{WORD_LENGTH} * (n_words - {EVENTS}) AND h_{WORD_LENGTH} * (n_words + {EVENTS})"])
    return f"""
    qr_base AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {docs}),
    qr_split AS (SELECT *, list_filter(string_split_regex(t, '{ws}+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM qr_base),
    qr_win AS (SELECT rid, i, array_to_string(ws[i:i + {SPAN - 1}], ' ') AS w FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - {SPAN - 2}, 1))) AS i FROM qr_split)),
    qr_dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM qr_win) WHERE n > 1),
    qr_cover AS (SELECT rid, sum(least({SPAN}, coalesce(nxt - i, {SPAN}))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM qr_dup) GROUP BY rid),
    qr_counts AS (SELECT b.*, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{ws}', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '{UPPER}', '', 'g')))::BIGINT AS n_upper
        FROM qr_split b LEFT JOIN qr_cover c USING (rid)),
    qr_stats AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM qr_counts),
    qr_bins AS (SELECT lang, source, metric, (v >> greatest(length(bin(v)) - {SUB_BITS + 1}, 0)) << greatest(length(bin(v)) - {SUB_BITS + 1}, 0) AS bin, count(*) AS n FROM ({long}) GROUP BY ALL),
    {level("own", "lang, source")},
    {level("wide", "lang")},
    {level("whole", "")},
    qr_shrunk AS (SELECT o.lang, o.source, o.metric, {quantiles} FROM qr_q_own o JOIN qr_q_wide w ON o.lang IS NOT DISTINCT FROM w.lang AND o.metric = w.metric JOIN qr_q_whole c ON o.metric = c.metric),
    qr_bounds AS (SELECT *, {least} - {REACH} * ({middle} - {least}) AS low, {most} + {most} // {1 << SUB_BITS} + {REACH} * ({most} - {middle}) AS high FROM qr_shrunk),
    qr_fences AS (SELECT lang AS f_lang, source AS f_source, {sides} FROM qr_bounds GROUP BY lang, source),
    qr_judged AS (SELECT r.*, NOT base_failed AND coalesce({verdict}, false) AS kept FROM qr_stats r LEFT JOIN qr_fences ON lang IS NOT DISTINCT FROM f_lang AND source IS NOT DISTINCT FROM f_source)"""


ORACLE_SQL = f"""WITH {judged_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM qr_judged"""
