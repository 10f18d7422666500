"""Image layers and tiles: names, request parameters and a retrying, cache-first reader."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from gridsight.staging import filesystem, put

#: Flight years with the service's layer names.
LAYERS = {
    2014: "Ortoilmakuva_2014",
    2015: "Ortoilmakuva_2015_20cm",
    2016: "Ortoilmakuva_2016",
    2017: "Ortoilmakuva_2017_8cm",
    2018: "Ortoilmakuva_2018",
    2019: "Ortoilmakuva_2019_20cm",
    2020: "Ortoilmakuva_2020",
    2021: "Ortoilmakuva_2021_5cm",
    2023: "Ortoilmakuva_2023_5cm",
    2024: "Ortoilmakuva_2024_5cm",
    2025: "Ortoilmakuva_2025_5cm",
}
ATTEMPTS, LONGEST_WAIT, JPEG_START = 3, 30.0, b"\xff\xd8"


def layer_of(year: int) -> str:
    if year not in LAYERS:
        raise ValueError(f"no layer for {year}; there are {', '.join(map(str, sorted(LAYERS)))}")
    return LAYERS[year]


def tile_path(root: str, layer: str, zoom: int, col: int, row: int) -> str:
    return f"{root.rstrip('/')}/{layer}/{zoom}/{col}/{row}.jpg"


#: The tile service's matrix set and image format.
MATRIX_SET, IMAGE_FORMAT = "ETRS-GK25", "image/jpeg"


def tile_request(layer: str, zoom: int, col: int, row: int) -> dict[str, str]:
    """Parameters that ask a tile service for one tile of the grid."""
    asked = {"service": "WMTS", "version": "1.0.0", "request": "GetTile", "layer": layer, "style": "raster", "format": IMAGE_FORMAT}
    return {k.upper(): v for k, v in (asked | {"tilematrixset": MATRIX_SET, "tilematrix": f"{MATRIX_SET}:{zoom}", "tilerow": str(row), "tilecol": str(col)}).items()}


def pause(attempt: int, asked: str | None = None) -> float:
    """Seconds between attempts: doubling; what the service asks for counts if it is a number and longer, within a bound."""
    usual = float(2**attempt)
    number = asked is not None and re.fullmatch(r"\s*[0-9]+([.][0-9]*)?\s*", asked)
    return min(max(float(asked), usual), LONGEST_WAIT) if number else usual


def verdict(status: int, body: bytes, accept: Callable[[bytes], bool]) -> str:
    """What an answer means: ``take`` it, ``refuse`` to ask again, or ask ``again``."""
    if status == 200:
        return "take" if accept(body) else "again"
    return "refuse" if status // 100 == 4 and status != 429 else "again"


def ask(send: Callable[[], tuple[int, bytes, str | None]], accept: Callable[[bytes], bool], *, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The first answer (status, body, Retry-After) that is accepted, of ``ATTEMPTS``; a refusal is a LookupError, the rest an OSError."""
    faults: list[str] = []
    while len(faults) < ATTEMPTS:
        asked = None
        try:
            status, body, asked = send()
        except OSError as error:
            faults.append(str(error))
        else:
            match verdict(status, body, accept):
                case "take":
                    return body
                case "refuse":
                    raise LookupError(f"status {status}")
            faults.append(f"status {status}" if status != 200 else "unusable answer")
        if len(faults) < ATTEMPTS:
            sleep(pause(len(faults) - 1, asked))
    raise OSError(faults[-1])


def get_tile(fetch: Callable[[dict], tuple[int, bytes, str | None]], request: dict, *, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """A JPEG by ``fetch``."""
    return ask(lambda: fetch(request), lambda body: body.startswith(JPEG_START), sleep=sleep)


def fetch_tiles(tiles: DataFrame, root: str, layer: str, fetch: Callable[[dict], tuple[int, bytes, str | None]]) -> DataFrame:
    """``zoom, col, row, cached, error`` of every tile; those not in the cache under ``root`` are fetched into it.

    A tile that fails is a row with its error, never the end of the run. Tasks bound how
    many requests are in flight; ``root`` is a folder all executors share.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(root)
        for frame in frames:
            out = []
            for zoom, col, row in frame[["zoom", "col", "row"]].itertuples(index=False):
                path, error = tile_path(base, layer, zoom, col, row), None
                cached = fs.get_file_info(path).type != pafs.FileType.NotFound
                if not cached:
                    try:
                        put(fs, path, get_tile(fetch, {"layer": layer, "zoom": int(zoom), "col": int(col), "row": int(row)}))
                    except (OSError, LookupError) as fault:
                        error = str(fault)
                out.append((zoom, col, row, cached, error))
            yield pd.DataFrame(out, columns=["zoom", "col", "row", "cached", "error"])

    return tiles.select("zoom", "col", "row").mapInPandas(run, "zoom int, col long, row long, cached boolean, error string")
