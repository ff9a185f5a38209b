"""Near copies by SimHash, with an exact comparison of all fingerprints in tiles.

Fingerprints are cut into parts, and those with the same population count in every
part form a tile. Two fingerprints that differ in at most r bits have counts that
differ by at most r over all parts together, so only tiles within that distance are
compared, every pair in them, with exclusive-or and bit counts in numpy. Only
distinct fingerprints are compared: exact copies cost nothing.

The tiles skip most pairs for a small radius, but what is left still grows with the
square of the distinct fingerprints; see the README for figures.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.graph import components
from intentloom.llm.shared import LOWER, per_text, unused
from intentloom.session import settle

BITS = 64
#: Parts up to this radius, and beyond, where four counts would skip too little.
FINE_RADIUS, FINE_PARTS, COARSE_PARTS = 3, 4, 1
#: Fingerprints of a block, on average, by number of parts; blocks are what is sent.
BLOCKS = {FINE_PARTS: 4_096, COARSE_PARTS: 32_768}
#: Pairs that are compared at once, at 8 bytes each.
AT_ONCE = 1 << 20
SEED = 42


def fingerprint(text: str, shingle: int, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half of the hashes."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        found = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        ends = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        found = [digest(joined[a:b], seed) for a, b in zip(starts, ends)]
    hashes = np.array(found, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 65_536):
        part = np.unpackbits(hashes[start : start + 65_536], axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.uint32)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_udf(shingle: int, seed: int = SEED) -> Callable:
    """Arrow UDF: text -> fingerprint. Null, empty and wordless texts have 0."""
    return per_text(
        pa.int64(), "bigint", lambda: lambda text: fingerprint(text, shingle, seed)
    )


def _tile(fingerprint: Column, parts: int) -> Column:
    """Number of a tile: the population counts as digits."""
    width = BITS // parts
    tile = F.lit(0)
    for part in range(parts):
        bits = F.shiftrightunsigned(fingerprint, part * width)
        if width < BITS:
            bits = bits.bitwiseAND(F.lit((1 << width) - 1))
        tile = tile * (width + 1) + F.bit_count(bits)
    return tile.cast("int")


def _neighbours(tile: Column, radius: int, parts: int) -> Column:
    """Array of the tiles within the radius, the tile itself included; of two tiles
    only one has the other in its array."""
    counts = BITS // parts + 1
    scales = [counts ** (parts - 1 - part) for part in range(parts)]
    digits = [F.floor(tile / scale) % counts for scale in scales]
    ways = []
    for step in itertools.product(range(-radius, radius + 1), repeat=parts):
        if sum(map(abs, step)) > radius or step < (0,) * parts:
            continue
        inside = F.lit(True)
        for digit, move in zip(digits, step):
            if move:
                inside = inside & (digit + move).between(0, counts - 1)
        shift = sum(move * scale for move, scale in zip(step, scales))
        ways.append(F.when(inside, tile + F.lit(shift)))
    return F.array_compact(F.array(*ways))


def _forest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of links that connect what all the links connect."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[up]
        return node

    kept = []
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def _close(home: np.ndarray, guests: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Links between two blocks as rows (a, b), thinned to a forest if there are many.

    The forest takes the closest pairs first, so what it leaves out is connected by
    pairs that are at least as close.
    """
    found = []
    rows = max(1, AT_ONCE // max(1, len(home)))
    for start in range(0, len(guests), rows):
        part = guests[start : start + rows]
        distance = np.bitwise_count(part[:, None] ^ home[None, :])
        a, b = np.nonzero(distance <= radius)
        if same:
            upper = a + start < b
            a, b = a[upper], b[upper]
        if len(a) > len(part) + len(home):
            order = np.argsort(distance[a, b], kind="stable")
            a, b = a[order], b[order]
            kept = _forest(part[a], home[b])
            a, b = a[kept], b[kept]
        a, b = part[a], home[b]
        found.append(np.stack([a, b], axis=1))
    return np.concatenate(found)


def _compare(radius: int) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, np.empty(0, dtype=np.uint64)
        waiting: list[np.ndarray] = []
        done: list[np.ndarray] = []

        def flush() -> None:
            if waiting:
                done.append(_close(home, np.concatenate(waiting), radius, False))
                waiting.clear()

        for batch in batches:
            tiles, blocks, homes, prints = batch.columns
            for k in range(len(batch)):
                own = prints[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = (tiles[k].as_py(), blocks[k].as_py())
                if homes[k].as_py():
                    flush()
                    key, home = at, own
                    done.append(_close(home, home, radius, True))
                elif at == key:
                    waiting.append(own)
                    if sum(map(len, waiting)) * len(home) > AT_ONCE:
                        flush()
            flush()
            links = np.concatenate(done).view(np.int64) if done else np.empty((0, 2), np.int64)
            done.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"]
            )

    return compare


def close_pairs(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs within `radius` bits connect.

    `distinct` is a stored table with one row per fingerprint. There are at most
    17^4 tiles, whatever the data, so their sizes may be broadcast; a large tile is
    cut by a hash into blocks of some thousand fingerprints. Each block is sent to the
    blocks of the tiles around its own, and compared there while it streams by.
    """
    parts = FINE_PARTS if radius <= FINE_RADIUS else COARSE_PARTS
    tiled = distinct.select("fingerprint", _tile(F.col("fingerprint"), parts).alias("tile"))
    sizes = settle(
        tiled.groupBy("tile").agg(
            F.ceil(F.count("*") / F.lit(BLOCKS[parts])).cast("int").alias("blocks")
        ),
        "tiles",
    )
    block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    blocks = settle(
        tiled.join(F.broadcast(sizes), "tile")
        .groupBy("tile", block.alias("block"))
        .agg(F.collect_list("fingerprint").alias("prints")),
        "blocks",
    )
    homes = blocks.select("tile", "block", F.lit(True).alias("home"), "prints")
    around = sizes.select(
        F.col("tile").alias("from_tile"),
        F.explode(_neighbours(F.col("tile"), radius, parts)).alias("tile"),
    )
    around = settle(
        around.join(F.broadcast(sizes), "tile").select(
            "from_tile", "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        ),
        "tile-pairs",
    )
    guests = (
        blocks.select(F.col("tile").alias("from_tile"), F.col("block").alias("from_block"), "prints")
        .join(around, "from_tile")
        .where("from_tile <> tile or from_block < block")
        .select("tile", "block", F.lit(False).alias("home"), "prints")
    )
    meeting = homes.unionByName(guests).repartition("tile", "block")
    meeting = meeting.sortWithinPartitions("tile", "block", F.desc("home"))
    return meeting.mapInArrow(_compare(radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: `id_col`, `fingerprint` bigint, `component` (its smallest id).

    Texts are lower-cased (A-Z), words are runs without ASCII white space, shingles
    of `shingle` words count as often as they occur. A text of fewer words is one
    shingle. Null, empty and wordless texts have fingerprint 0. Fingerprints within
    `radius` bits are linked, and texts of one fingerprint belong together.

    Repeated rows and ids are rows of their own; a null id counts as larger than all
    others, so `component` is null only where every id of the component is. Other
    columns are not read. Empty tables give empty results.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = settle(
        own.select("id", fingerprint_udf(shingle)(F.col("text")).alias("fingerprint")),
        "fingerprints",
    )
    named = _named(prints, radius).select("fingerprint", "component")
    return prints.join(named, "fingerprint").select(
        F.col("id").alias(id_col), "fingerprint", "component"
    )


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """fingerprint, root of its component, component; one row per fingerprint, stored."""
    distinct = prints.groupBy("fingerprint").agg(F.min("id").alias("id"))
    distinct = settle(distinct, "distinct")
    linked = components(close_pairs(distinct, radius)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(linked, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = rooted.join(smallest, "root").select("fingerprint", "root", "component")
    return settle(named, "components")


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` with one row of each component of `near_duplicates`: that of its smallest id.

    All columns stay. A null id counts as larger than all others. Of several rows with
    the smallest id that of the smallest hash of the whole row stays, and of equal rows
    one, so a rerun keeps the same.

    Rows are known by their id and hash: only these are shuffled to find what goes. Texts
    move only where many rows go (few are broadcast) or whole rows are repeated.
    """
    row_hash, known = unused(docs, "_hash"), unused(docs, "_known")
    # columns that have no order or hash, as maps, don't take part
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = docs.withColumn(row_hash, F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    prints = settle(
        keyed.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(row_hash).alias("hash"),
            fingerprint_udf(shingle)(F.col(f"`{text_col}`")).alias("fingerprint"),
        ),
        "fingerprints",
    )
    rows = prints.groupBy("id", "hash", "fingerprint").agg(F.count("*").alias("n"))
    rows = settle(rows.join(_named(prints, radius), "fingerprint"), "rows")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    first = rows.groupBy("root").agg(F.min(order).alias("first")).withColumnRenamed("root", "r")
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    judged = rows.join(first, rows["root"] == first["r"]).select("id", "hash", "n", kept.alias("kept"))
    judged = settle(judged.where("not kept or n > 1"), "judged")

    def of(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("id").alias(known), F.col("hash").alias(f"{known}_hash"))
        same = keyed[id_col].eqNullSafe(keys[known]) & (keyed[row_hash] == keys[f"{known}_hash"])
        return keyed.join(keys, same, how)

    alone = of(judged, "left_anti")
    repeated = of(judged.where("kept"), "left_semi").dropDuplicates([id_col, row_hash])
    return alone.unionByName(repeated).drop(row_hash)
