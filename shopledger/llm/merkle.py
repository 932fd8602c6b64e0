"""Merkle manifest of a dataset, with a witness for every row.

Rows are leaves of one tree per group (a source, a snapshot); the trees' roots are the
leaves of one more tree. A tree grows by append: a leaf begins with an empty witness,
and whenever a run of siblings completes, the witnesses below each of them are extended
by the digests to its left and right.

On a cluster each tree is cut into aligned blocks of ``BLOCK`` leaves. A task appends
the leaves of a block in order and gives the block's root; block roots are appends to
the levels above, cut into blocks in turn. On the way down the witness of a block's
root precedes its leaves in their stream and is put at the end of theirs. A block has
at most ``BLOCK`` rows, however many its tree has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.scratch import written

FAN = 16
LEVELS = 2
BLOCK = FAN**LEVELS

Step = tuple[str, str]

WITNESS = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
_WITNESS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
# Rows of the last table of a stream, with their witnesses, given out at once.
_OUT_ROWS = 4 * BLOCK


def framed(value: Column) -> Column:
    """A value so that no two rows frame alike: ``-`` for null, else the length in
    UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def proof_digest(witness: Column) -> Column:
    """One digest of all siblings, from the leaf's to those of the last root."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf has with a witness."""
    return F.aggregate(witness, leaf, lambda under, s: F.sha2(F.concat(s["left"], under, s["right"]), 256))


def levels_of(nodes: int) -> int:
    """Levels that a block closes: all of a tree that is one block, else ``LEVELS``."""
    levels, reach = 0, 1
    while reach < nodes and levels < LEVELS:
        levels, reach = levels + 1, reach * FAN
    return levels


class Appender:
    """The part of a tree above the leaves appended so far. Each level has one open run
    of nodes, and each node knows the witnesses of the leaves below it."""

    def __init__(self) -> None:
        self._open: list[list[tuple[str, list[list[Step]]]]] = [[]]

    def append(self, digest: str) -> list[Step]:
        """Add a leaf. Its witness comes back empty and grows as runs complete."""
        witness: list[Step] = []
        self._add(0, digest, [witness])
        return witness

    def _add(self, level: int, digest: str, below: list[list[Step]]) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append((digest, below))
        if len(self._open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        whole = "".join(digest for digest, _ in run)
        size = len(whole) // len(run)
        for i, (_, below) in enumerate(run):
            step = whole[: i * size], whole[(i + 1) * size :]
            for witness in below:
                witness.append(step)
        self._add(level + 1, hashlib.sha256(whole.encode()).hexdigest(), [w for _, below in run for w in below])

    def finish(self, levels: int) -> str:
        """Complete what is open below ``levels``; the root there."""
        for level in range(levels):
            if level < len(self._open) and self._open[level]:
                self._complete(level)
        ((root, _),) = self._open[levels]
        return root


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time, from rows sorted by tree and block."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        names = list(zip(rows["tree"].to_pylist(), rows["block"].to_pylist(), strict=True))
        first = 0
        for i in range(1, len(names)):
            if names[i] != names[i - 1]:
                yield rows.slice(first, i - first)
                first = i
        held = rows.slice(first).combine_chunks()
    if held is not None:
        yield held


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list] = {"tree": [], "block": [], "nodes": [], "digest": []}

    def out() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(found.values(), kinds, strict=True)], list(found)
        )

    for rows in _blocks(batches):
        tree = Appender()
        for digest in rows["digest"].to_pylist():
            tree.append(digest)
        nodes = rows["nodes"][0].as_py()
        found["tree"].append(rows["tree"][0].as_py())
        found["block"].append(rows["block"][0].as_py())
        found["nodes"].append(nodes)
        found["digest"].append(tree.finish(levels_of(nodes)))
        if len(found["tree"]) >= _OUT_ROWS:
            yield out()
            for values in found.values():
                values.clear()
    yield out()


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves with their whole witness; the first row of each block is its header."""
    for block in _blocks(batches):
        header, rows = block.slice(0, 1), block.slice(1)
        above = [(s["left"], s["right"]) for s in header["witness"][0].as_py()]
        tree = Appender()
        witnesses = [tree.append(digest) for digest in rows["digest"].to_pylist()]
        tree.finish(levels_of(rows["nodes"][0].as_py()))
        steps = [step for witness in witnesses for step in (*witness, *above)]
        ends = [0]
        for witness in witnesses:
            ends.append(ends[-1] + len(witness) + len(above))
        left, right = ([s[i] for s in steps] for i in (0, 1))
        pairs = pa.StructArray.from_arrays([pa.array(left, type=pa.string()), pa.array(right, type=pa.string())], ["left", "right"])
        n = rows.num_rows
        columns = {
            "tree": rows["tree"],
            "digest": rows["digest"],
            "row": rows["row"],
            "subroot": pa.array(header["subroot"].to_pylist() * n, type=pa.string()),
            "root": pa.array(header["root"].to_pylist() * n, type=pa.string()),
            "witness": pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pairs).cast(_WITNESS),
        }
        yield from pa.table(columns).combine_chunks().to_batches()


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def _witnessed(rows: DataFrame, largest: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (tree, at, nodes of the tree, digest, row) with subroot, root and
    witness. ``largest`` is the most nodes of a tree; ``above`` gives the root of each
    tree its header: tree, subroot, root, witness."""
    rows = rows.withColumn("block", F.expr(f"at div {BLOCK}"))
    streamed = _in_blocks(rows.select("tree", "block", "at", "nodes", "digest"))
    roots = written(streamed.mapInArrow(_roots, "tree string, block long, nodes long, digest string"), "merkle-roots")
    if largest > BLOCK:
        appended = roots.select(
            "tree",
            F.col("block").alias("at"),
            F.expr(f"(nodes + {BLOCK - 1}) div {BLOCK}").alias("nodes"),
            "digest",
            F.struct("block").alias("row"),
        )
        found = _witnessed(appended, -(-largest // BLOCK), above)
        headers = found.select("tree", F.col("row.block").alias("block"), "subroot", "root", "witness")
    else:
        headers = above(roots).select("tree", F.lit(0).cast("long").alias("block"), "subroot", "root", "witness")
    kind = rows.schema["row"].dataType
    stream = rows.select("tree", "block", "at", "nodes", "digest", "row").unionByName(
        headers.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True
    )
    out = T.StructType(
        [
            T.StructField("tree", T.StringType()),
            T.StructField("digest", T.StringType()),
            T.StructField("row", kind),
            T.StructField("subroot", T.StringType()),
            T.StructField("root", T.StringType()),
            T.StructField("witness", WITNESS),
        ]
    )
    return _in_blocks(stream).mapInArrow(_extended, out)


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows``, a written table with a column tree, each with its place in its tree
    (``at``, from 0) and the tree's number of ``nodes``, and the most nodes of any
    tree. Rows are sorted by ranges of tree and order, so a large tree lies in many
    parts; rows that are alike are told apart by where they were read."""
    keys = ["tree", *order, "_read"]
    dealt = (
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_read")
    )
    # The id counts up within a part, and the part's number is above its 33rd bit.
    placed = written(dealt.withColumn("_id", F.monotonically_increasing_id()), "merkle-leaves")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    parts = placed.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # A tree has one row per part here.
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("nodes"),
    )
    parts = written(parts, "merkle-parts")
    largest = parts.agg(F.max("nodes")).first()[0] or 0
    numbered = placed.join(parts, ["tree", "_part"]).withColumn("at", F.col("_id") + F.col("_shift"))
    return numbered.drop("_id", "_part", "_shift"), largest


def _no_more(roots: DataFrame) -> DataFrame:
    """The header of the one root that nothing is above of."""
    return roots.select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(WITNESS).alias("witness"))


def _of_trees(roots: DataFrame) -> DataFrame:
    """Headers of the trees' roots, the leaves of one more tree in the trees' order."""
    leaves = roots.select(F.lit("").alias("tree"), "digest", F.struct("tree").alias("row"), F.col("tree").alias("_name"))
    numbered, trees = _numbered(leaves, ["_name"])
    found = _witnessed(numbered.drop("_name"), trees, _no_more)
    return found.select("row.tree", F.col("digest").alias("subroot"), "root", "witness")


def manifest(rows: DataFrame, *, tree: Column, order: Sequence[Column], leaf: Column, carried: Sequence[Column]) -> DataFrame:
    """Every row of ``rows`` with its place in the dataset's Merkle tree: the ``carried``
    columns, leaf, subroot (of its tree), root (of all) and witness, the digests (left,
    right) of its siblings on each level, from its own up to the last.

    ``tree`` names a row's tree (null is a tree of its own, before all others; else by
    UTF-8 bytes), ``order`` sorts the leaves in it (nulls first). Rows that tie are
    sorted by ``leaf``, so equal rows may change places but no digest does. While a level
    has several nodes, each run of ``FAN`` becomes the digest of its digests, a shorter
    last run as well. An empty table gives no rows."""
    kept = [f"_o{i}" for i in range(len(order))]
    leaves = written(
        rows.select(
            F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("")).alias("tree"),
            *(c.alias(name) for c, name in zip(order, kept, strict=True)),
            leaf.alias("digest"),
            F.struct(*carried).alias("row"),
        ),
        "merkle-rows",
    )
    numbered, largest = _numbered(leaves, [*kept, "digest"])
    found = _witnessed(numbered.drop(*kept), largest, _of_trees)
    return found.select("row.*", F.col("digest").alias("leaf"), "subroot", "root", "witness")


def tampered_text() -> Column:
    """What a careless copy did to every fifth document or so: A-Z in lower case."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate("text", capitals, capitals.lower())


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text) by source and
    doc_id, and the check of a copy in which texts have changed where 5 divides the
    CRC-32 of the doc_id: doc_id, leaf, subroot, root, proof_sha256, folded_root and
    verified. Rows without doc_id come first in their source and are not changed; of
    rows with one doc_id the lesser leaf comes first."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    seen = F.when(changed, leaf_digest(*fields, tampered_text()))
    found = manifest(
        docs,
        tree=F.col("source"),
        order=[F.col("doc_id")],
        leaf=leaf_digest(*fields, F.col("text")),
        carried=[F.col("doc_id"), seen.alias("seen")],
    )
    out = found.withColumns(
        {
            "proof_sha256": proof_digest(F.col("witness")),
            "folded_root": folded(F.coalesce("seen", "leaf"), F.col("witness")),
        }
    )
    return out.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
