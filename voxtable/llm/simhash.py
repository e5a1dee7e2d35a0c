"""SimHash near-dedup: fingerprints of word shingles, linked through sharded vantage-point trees.

Two fingerprints within ``r`` bits are within ``r // s`` bits in one of ``s`` equal segments. So
there is one tree for each segment, over a short key and a small radius, where the triangle bounds
prune far more than over whole fingerprints. The shards of a tree partition the fingerprints by
Hamming distance; a fingerprint near a boundary is also sent to the shards beyond it, as a query.
Every link is decided on the whole fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.llm import vptree
from voxtable.llm.components import smallest_reachable
from voxtable.llm.frames import column, join_counted, nested, restored, text_of
from voxtable.ship import ship_package
from voxtable.sources.tables import materialize

BITS = 64
# A cell is named (segment * MAX_SHARDS + shard) * MAX_TILES + tile.
MAX_SHARDS = 1 << 20
MAX_TILES = 1 << 20


def fingerprint(text: str, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles, repeats included."""
    words = text.encode().lower().split()  # bytes know A-Z and the ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths)[:count].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for part in np.split(hashes, range(65_536, count, 65_536)):
        bits = np.unpackbits(part.view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """The rows of ``nested`` with their fingerprint, as a signed 64-bit integer."""

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return df.withColumn("fingerprint", fingerprints(F.col(text_col)))


def _keys(points: np.ndarray, segment: int, segments: int) -> np.ndarray:
    width = BITS // segments
    return points >> np.uint64(segment * width) & np.uint64((1 << width) - 1)


def _routes(
    trees: list[vptree.Shards],
    tiles: dict[int, int],
    parts: dict[int, int],
    segments: int,
    radius: int,
):
    """Rows ``(cell, part, fingerprint, is_home)``: where a fingerprint is stored, and where it asks.

    A pair of shards needs only one of both to ask, the one of the lower number. A shard of many
    points is stored in tiles; a fingerprint then asks the tiles after its own, or all tiles of
    another shard. A cell that many ask is stored in each of its parts, and a fingerprint asks one.
    """
    large = np.array(sorted(parts), np.int64)
    number = np.array([parts[c] for c in large.tolist()], np.int64)

    def parts_of(cells: np.ndarray) -> np.ndarray:
        if not len(large):
            return np.ones(len(cells), np.int64)
        at = np.minimum(np.searchsorted(large, cells), len(large) - 1)
        return np.where(large[at] == cells, number[at], 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for segment, tree in enumerate(trees):
                keys = _keys(points, segment, segments)
                home = tree.home(keys)
                index, shard = tree.reached(keys, radius)
                asks = shard > home[index]
                index = np.concatenate([np.arange(len(points)), index[asks]])
                shard = np.concatenate([home, shard[asks]])
                shard = segment * MAX_SHARDS + shard.astype(np.int64)
                is_home = np.arange(len(index)) < len(points)
                many = np.ones(len(shard), np.int64)
                for large, number in tiles.items():
                    many[shard == large] = number
                own = np.where(is_home, (points[index] % many.astype(np.uint64)).astype(np.int64), 0)
                copies = many - own
                at = np.repeat(np.arange(len(index)), copies)
                tile = own[at] + np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                cell, point = shard[at] * MAX_TILES + tile, points[index[at]]
                stored = is_home[at] & (tile == own[at])
                of_cell = parts_of(cell)
                copies = np.where(stored, of_cell, 1)
                at = np.repeat(np.arange(len(cell)), copies)
                part = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                asked = (point[at] % of_cell[at].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell[at]),
                        pa.array(np.where(stored[at], part, asked)),
                        pa.array(point[at].view(np.int64)),
                        pa.array(stored[at]),
                    ],
                    ["cell", "part", "fingerprint", "is_home"],
                )

    return route


def near_links(
    distinct: DataFrame,
    rows: int,
    within: int,
    segments: int,
    shard_points: int,
    tile_points: int,
    sample: int,
) -> DataFrame:
    """Links ``(a, b)`` that connect what a chain of near fingerprints connects.

    ``distinct`` holds ``rows`` different fingerprints. Each cell returns a star for each group
    that it connects, so a dense group has as many links as members and not as many as pairs.
    """
    ship_package(distinct.sparkSession)
    radius = within // segments
    points = distinct.select("fingerprint")
    # About ``sample`` fingerprints in all, however many tasks read them.
    chosen = F.pmod(F.xxhash64("fingerprint"), F.lit(max(1, rows // sample))) == 0
    drawn = points.where(chosen).toPandas()
    known = np.sort(drawn["fingerprint"].to_numpy().astype(np.int64)).view(np.uint64)
    shards = min(max(4, -(-rows // shard_points)), MAX_SHARDS - 1)
    trees = [
        vptree.Shards.build(_keys(known, s, segments), shards) if len(known) else vptree.Shards([], 1)
        for s in range(segments)
    ]
    schema = "cell bigint, part bigint, fingerprint bigint, is_home boolean"

    def routed(tiles: dict[int, int], parts: dict[int, int]) -> DataFrame:
        return points.mapInArrow(_routes(trees, tiles, parts, segments, radius), schema)

    def larger(cells: DataFrame) -> dict[int, int]:
        """Cells of more than ``tile_points`` rows, fewer than there are such numbers of rows, and
        into how many they are split."""
        sizes = cells.groupBy("cell").count().where(F.col("count") > tile_points)
        return {r["cell"]: -(-r["count"] // tile_points) for r in sizes.collect()}

    tiles = {c // MAX_TILES: n for c, n in larger(routed({}, {}).where("is_home")).items()}
    parts = larger(routed(tiles, {}).where("not is_home"))

    def link(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["is_home", "fingerprint"], ascending=[False, True])
        own = cell["fingerprint"].to_numpy().view(np.uint64)
        segment = int(cell["cell"].iloc[0]) // MAX_TILES // MAX_SHARDS
        keys = _keys(own, segment, segments)
        homes, first = int(cell["is_home"].sum()), int(cell["part"].iloc[0]) == 0
        roots = vptree.connected(keys, own, homes, radius, within, first)
        linked = np.flatnonzero(roots != np.arange(len(own)))
        signed = own.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[roots[linked]]})

    cells = routed(tiles, parts).groupBy("cell", "part")
    return cells.applyInPandas(link, "a bigint, b bigint")


def _near_groups(
    df: DataFrame,
    id_col: str,
    text_col: str,
    columns: list[str],
    shingle: int,
    within: int,
    segments: int,
    shard_points: int,
    tile_points: int,
    sample: int,
) -> DataFrame:
    """Rows as ``(row, fingerprint, component_id, kept)``."""
    ship_package(df.sparkSession)
    place = F.monotonically_increasing_id()  # stored, so it never changes
    rows = nested(df, columns, id=column(id_col), text=text_of(text_col), place=place)
    stored = materialize(with_fingerprint(rows, "text", shingle).drop("text"))
    total = stored.count()

    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("first")
    distinct = materialize(
        stored.groupBy("fingerprint").agg(F.count("*").alias("n"), first)
    )
    different = distinct.count()
    links = near_links(
        distinct, different, within, segments, shard_points, tile_points, sample
    )
    reached = smallest_reachable(links)
    rooted = materialize(
        distinct.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("root", F.coalesce("root", "fingerprint"))
    )
    firsts = materialize(
        rooted.groupBy("root").agg(F.min("first").alias("of_all"), F.count("*").alias("members"))
    )
    groups = materialize(
        join_counted(rooted, firsts, "root", "members", different).select(
            "fingerprint", "n", "of_all"
        )
    )
    joined = join_counted(stored, groups, "fingerprint", "n", total)
    return joined.select(
        "row",
        "fingerprint",
        F.col("of_all.id").alias("component_id"),
        (F.col("place") == F.col("of_all.place")).alias("kept"),
    )


def mark_near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    shingle: int = 4,
    within: int = 4,
    segments: int = 4,
    shard_points: int = 20_000,
    tile_points: int = 200_000,
    sample: int = 50_000,
) -> DataFrame:
    """Every row with its fingerprint and the component of near fingerprints that it belongs to.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a shingle is ``shingle``
    words in a row, or all words of a shorter text. A text without words, null or empty, has the
    fingerprint zero and is linked like any other. Fingerprints that differ in ``within`` bits at
    most are linked; ``component_id`` is the smallest id that links reach, null ids being larger
    than any other. ``kept`` holds for one row of each component, the first by id. An empty table
    gives an empty table.

    Returns the columns of ``carry`` (all by default) with ``fingerprint`` (16 hexadecimal digits),
    ``component_id`` and ``kept``; an input column of such a name gives way.

    All links are found whatever the other parameters: ``segments`` divides 64, ``shard_points``
    and ``tile_points`` size the tasks, and some ``sample`` fingerprints, twice as many at most,
    fit the shards' boundaries.
    """
    columns = df.columns if carry is None else carry
    sizes = (shingle, within, segments, shard_points, tile_points, sample)
    return restored(
        _near_groups(df, id_col, text_col, columns, *sizes),
        columns,
        fingerprint=F.lower(F.lpad(F.hex("fingerprint"), 16, "0")),
        component_id=F.col("component_id"),
        kept=F.col("kept"),
    )


def drop_near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    within: int = 4,
    segments: int = 4,
    shard_points: int = 20_000,
    tile_points: int = 200_000,
    sample: int = 50_000,
) -> DataFrame:
    """The rows that ``mark_near_duplicates`` keeps, with exactly the columns of the input."""
    sizes = (shingle, within, segments, shard_points, tile_points, sample)
    rows = _near_groups(df, id_col, text_col, df.columns, *sizes)
    return restored(rows.where("kept"), df.columns)
