"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has a bit for each bit that is set in over half of the hashes of a text's shingles.
Distinct fingerprints are dealt into classes by the number of bits set in their lower and upper
half. Two fingerprints within the radius have counts that differ by no more than the radius in
total, so a class is compared with the few classes near it and all other tile pairs are skipped.
Classes are cut into tiles of bounded size; a task compares one tile with one block of the rows
near it by exclusive-or and bit counts and returns a forest of the links it found."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import Forest, components, picked
from docketry.session import cut_lineage

SEED = 42
TILE = 32_768
CELLS = 1 << 21


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle in parts; a text of fewer words has one shingle, all of it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts, one = [0, *ends], xxhash.xxh64_intdigest
    for at in range(0, len(words) - size + 1, 65_536):
        spans = zip(starts[at : at + 65_536], ends[at + size - 1 : at + size - 1 + 65_536], strict=False)
        yield np.array([one(joined[a : b - 1], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, size: int) -> int:
    """The 64 majority bits as a signed number; 0 for a text without words."""
    count, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.int64)[0]) if n else 0


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp) of every row; a null or empty text has fingerprint 0."""

    def run(batches):
        for b in batches:
            fp = pa.array([fingerprint(x, size) for x in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])

    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def near_steps(radius: int) -> list[tuple[int, int]]:
    """Half of the differences of bit counts that a pair within the radius can have."""
    steps = range(-radius, radius + 1)
    return [(x, y) for x in steps for y in steps if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]


def compare_tile(table: pa.Table, radius: int) -> pa.Table:
    """Links between a tile (role 0) and a block of rows near it (role 1), by the rows' nodes."""
    fp, role, node = (table[c].to_numpy() for c in ("fp", "role", "node"))
    fps, first, place = np.unique(fp.view(np.uint64), return_index=True, return_inverse=True)
    nodes, left, right = node[first], place[role == 0], place[role == 1]
    forest, step = Forest(len(fps)), max(1, CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        some = left[at : at + step]
        i, j = np.nonzero(np.bitwise_count(fps[some][:, None] ^ fps[right][None, :]) <= radius)
        a, b = some[i], right[j]
        forest.add(a[a != b], b[a != b])
    a, b = forest.links()
    return pa.table({"a": nodes[a], "b": nodes[b]})


def near_links(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join the rows of nodes (node, fp), whose fingerprints differ, as all pairs
    within the radius do.

    The driver gets the size of each of the at most 33 x 33 classes."""
    half = (1 << 32) - 1
    classed = nodes.select(
        "node",
        "fp",
        F.bit_count(F.col("fp").bitwiseAND(F.lit(half))).alias("c0"),
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("c1"),
    )
    count = {(r["c0"], r["c1"]): r["n"] for r in classed.groupBy("c0", "c1").agg(F.count("*").alias("n")).collect()}
    steps, rows = near_steps(radius), []
    for (x, y), n in count.items():
        near = [(x + i, y + j) for i, j in steps if (x + i, y + j) in count]
        blocks, tiles = -(-sum(count[c] for c in near) // tile), -(-n // tile)
        rows.append((x, y, x, y, 0, tiles, blocks))
        rows += [(*c, x, y, 1, tiles, blocks) for c in near]
    plan = nodes.sparkSession.createDataFrame(rows, "c0 int, c1 int, t0 int, t1 int, role int, tiles int, blocks int")
    mixed, is_tile = F.xxhash64("fp"), F.col("role") == 0
    own = F.when(is_tile, F.pmod(mixed, "tiles")).otherwise(F.pmod(F.shiftright(mixed, 20), "blocks")).cast("int")
    dealt = (
        classed.join(F.broadcast(plan), ["c0", "c1"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_tile, F.col("blocks")).otherwise(F.col("tiles")) - 1)))
        .select("node", "fp", "role", "t0", "t1",
                F.when(is_tile, own).otherwise(F.col("other")).alias("tile"),
                F.when(is_tile, F.col("other")).otherwise(own).alias("block"))
    )
    return dealt.groupBy("t0", "t1", "tile", "block").applyInArrow(lambda t: compare_tile(t, radius), "a long, b long")


def near_copies(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row of docs (doc_id, text).

    component_id is the smallest doc_id that links of at most `radius` differing bits reach. Equal
    fingerprints are one node, so copies cost nothing; texts without words, null ones too, share
    fingerprint 0. A row without doc_id has a fingerprint but is in no group: its component_id is
    null and it links nothing. Rows with one doc_id are one document, so their groups are one. Repeated
    rows stay repeated, no rows give no rows, other columns are
    not read."""
    prints = cut_lineage(fingerprints(docs, shingle))  # read again below
    nodes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    groups = components(near_links(nodes, radius, tile)).toDF("linked", "root")
    named = nodes.join(groups, nodes.node == groups.linked, "left").select(
        F.col("fp").alias("print"), F.coalesce("root", "node").alias("component_id")
    )
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, (prints.fp == named.print) & prints.doc_id.isNotNull(), "left").select("doc_id", "fp", hexed, "component_id")
