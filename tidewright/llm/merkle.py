"""Merkle manifest of a dataset: a root, the subroots of its sources, and a proof per row.

A row's leaf is the SHA-256 of its columns, each written as ``-`` if null, else as
its UTF-8 byte count, ``:`` and its value. The leaves of a source ascend by id, and
every ``FAN`` consecutive nodes become the hash of their hashes until one is left,
the source's subroot; the subroots by source give the root in the same way.

Every node carries the interval [lo, hi) of the leaf ranks it covers. Ranks come
from one range-partitioned sort with a running count over its partitions, so that
a source of any size is spread evenly. Levels are bucketed into bands of ``BAND``:
a task builds all levels of a band over one run of ``FAN ** BAND`` = 729 nodes, so a
tree of n leaves takes log(n) / log(729) shuffles. From the top down, each run is joined
to the run of the band above whose interval contains it, which hands it the rest of
its path. A node's siblings are what remains of its parent's interval without its
own: those that end before it begins stand to its left, the others to its right. All
of this is DataFrame expressions.

Cases: any column may be null; null sources and null ids come first. Empty and very
long texts are hashed whole. Rows of equal ids ascend by their leaves, and equal rows
get a place each. A single leaf is its own subroot, a single subroot the root; their
proofs are the hash of nothing. An empty table gives an empty result. Only the named
columns are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import small_side, written

FAN = 3
BAND = 6
# A side of a join with whole paths, some kilobytes each, is broadcast up to this many rows.
PATH_ROWS = 4000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# The levels above n nodes: as many as there are FAN**i < n.
_HEIGHT = f"size(filter(array({', '.join(f'{FAN**i}L' for i in range(40))}), p -> p < members))"

# One level above an array of nodes.
_PARENTS = (
    f"transform(sequence(0, (size(nodes) - 1) div {FAN}), i -> named_struct("
    f"'lo', nodes[{FAN} * i].lo, 'hi', nodes[least({FAN} * i + {FAN - 1}, size(nodes) - 1)].hi, "
    f"'digest', sha2(cast(array_join(slice(nodes, {FAN} * i + 1, {FAN}).digest, '') AS binary), 256)))"
)


def _steps(band: int) -> str:
    return f"array({', '.join(map(str, range(band)))})"


def _levels(band: int) -> str:
    """The levels of a band over ``run``, the lowest one first."""
    above = _PARENTS.replace("nodes", "element_at(levels, -1)")
    foot = "transform(run, e -> named_struct('lo', e.lo, 'hi', e.hi, 'digest', e.digest))"
    return (
        f"aggregate(slice({_steps(band)}, 1, least(height, {band})), array({foot}), "
        f"(levels, step) -> concat(levels, array({above})))"
    )


def _path(band: int) -> str:
    """The path of node ``p`` of a run: what stands left and right of it, level by level."""
    place = f"(p div array({', '.join(str(FAN**i) for i in range(band))})[j])"
    family, own = f"slice(levels[j], {FAN} * ({place} div {FAN}) + 1, {FAN})", f"levels[j][{place}]"

    def side(outside: str) -> str:
        return f"array_join(filter({family}, x -> {outside}).digest, '')"

    return (
        f"concat(transform(slice({_steps(band)}, 1, size(levels) - 1), j -> named_struct("
        f"'left', {side(f'x.hi <= {own}.lo')}, 'right', {side(f'x.lo >= {own}.hi')})), path)"
    )


def _hashed(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _leaf(values: Sequence[Column]) -> Column:
    texts = [v.cast("string") for v in values]
    return _hashed(
        F.concat(
            *[
                F.when(t.isNull(), F.lit("-")).otherwise(
                    F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)
                )
                for t in texts
            ]
        )
    )


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with their ``rank`` within the group by ``order``, which begins with the
    group, and the group's ``members``; a hot group spreads over many partitions."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # A partition number above a place in the partition.
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    counted = placed.groupBy(group, part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(group)
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = written(
        counted.select(
            F.col(group).alias("of"),
            "part",
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(whole).alias("members"),
        ),
        "parts",
    )
    same = F.col(group).eqNullSafe(F.col("of")) & (part == F.col("part"))
    joined = placed.join(small_side(parts), same)
    return joined.select(*rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "members")


@dataclass(frozen=True)
class Manifest:
    """``bands`` and ``top`` hold runs of nodes with all their levels within a band:
    those of the sources' trees and of the tree of subroots. ``trees``: tree, source,
    members, height. The runs of the lowest band name their rows."""

    trees: DataFrame
    bands: list[DataFrame]
    top: list[DataFrame]
    band: int

    def nodes(self) -> DataFrame:
        """(source, level, lo, hi, digest) of all nodes of the sources' trees."""
        found = None
        for b, runs in enumerate(self.bands):
            skip = 0 if b == 0 else 1  # the band below has listed this band's lowest level
            at = runs.select("tree", F.posexplode("levels").alias("step", "nodes")).where(F.col("step") >= skip)
            at = at.select("tree", (F.col("step") + b * self.band).alias("level"), F.inline("nodes"))
            found = at if found is None else found.unionByName(at)
        return found.join(self.trees.select("tree", "source"), "tree").drop("tree")

    def subroots(self) -> DataFrame:
        """(source, members, subroot)."""
        return self.trees.join(_tops(self.bands, self.band), "tree").select("source", "members", F.col("digest").alias("subroot"))


def _built(entries: DataFrame, height: int, band: int, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The bands over ``entries`` (tree, rank, height, lo, hi, digest and the payload),
    of which no tree is higher than ``height``."""
    bands = []
    while True:
        block = F.floor(F.col("rank") / FAN**band).alias("block")
        run = F.struct("rank", "lo", "hi", "digest", *payload)
        runs = entries.groupBy("tree", block).agg(
            F.max("height").alias("height"), F.sort_array(F.collect_list(run)).alias("run")
        )
        carried = ", ".join(f"'{c}', e.{c}" for c in payload)
        runs = runs.select(
            "tree", "block", "height", F.expr(_levels(band)).alias("levels"),
            *([F.expr(f"transform(run, e -> named_struct({carried})) AS rows")] if payload else []),
        )
        bands.append(written(runs, "band"))
        if len(bands) * band >= height:
            return bands
        head = F.element_at("levels", -1)[0]
        entries = bands[-1].where(F.col("height") > band).select(
            "tree", F.col("block").alias("rank"), (F.col("height") - band).alias("height"),
            head["lo"].alias("lo"), head["hi"].alias("hi"), head["digest"].alias("digest"),
        )
        payload = ()


def _tops(bands: list[DataFrame], band: int) -> DataFrame:
    """(tree, digest) of the trees' roots: each tree ends in one of the bands."""
    ends = [b.where(F.col("height") <= band).select("tree", F.element_at("levels", -1)[0]["digest"].alias("digest")) for b in bands]
    found = ends[0]
    for e in ends[1:]:
        found = found.unionByName(e)
    return found


def build(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    source_column: str = "source",
    columns: Sequence[str] = COLUMNS,
    presented: Mapping[str, Column] | None = None,
    band: int = BAND,
) -> Manifest:
    """The manifest of ``docs``. ``presented`` says, by column, what a holder of the
    data shows instead of a row's value, to be verified against the manifest."""
    presented = {c: v for c, v in (presented or {}).items()}
    values = [F.col(f"`{c}`") for c in columns]
    shown = [presented.get(c, F.col(f"`{c}`")) for c in columns]
    leaves = written(
        docs.select(
            F.col(f"`{source_column}`").cast("string").alias("source"),
            F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
            _leaf(values).alias("digest"),
            (_leaf(shown) if presented else F.lit(None).cast("string")).alias("shown"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "leaves",
    )
    placed = ranked(leaves, "source", ["source", "doc_id", "digest", "tie"])
    sizes = written(placed.groupBy("source").agg(F.max("members").alias("leaves")), "sizes").withColumn("one", F.lit(0))
    trees = written(
        ranked(sizes, "one", ["one", "source"])
        .select(F.col("rank").alias("tree"), "source", F.col("leaves").alias("members"))
        .select("*", F.expr(_HEIGHT).alias("height")),
        "trees",
    )
    of = small_side(trees.select("tree", "height", F.col("source").alias("of")))
    entries = placed.join(of, F.col("source").eqNullSafe(F.col("of"))).select(
        "tree", "rank", "height", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"),
        "digest", "doc_id", "shown",
    )
    facts = trees.agg(F.max("height"), F.count(F.lit(1)).alias("members")).select("*", F.expr(_HEIGHT)).first()
    bands = _built(entries, facts[0] or 0, band, ["doc_id", "shown"])
    top = _tops(bands, band).select(
        F.lit(0).alias("tree"), F.col("tree").alias("rank"), F.lit(facts[2]).alias("height"),
        F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest",
    )
    return Manifest(trees, bands, _built(top, facts[2], band), band)


_PATH_TYPE = "array<struct<left:string,right:string>>"


def _descended(bands: list[DataFrame], above: DataFrame, named: Sequence[str], band: int) -> DataFrame:
    """From (tree, path and the columns ``named``) of the trees' roots to the runs of the
    lowest band, with the path that leads on from each."""
    path = _path(band)
    pairs = "".join(f", '{c}', {c}" for c in named)
    # By band, from the top: the paths of its runs, those of trees that end in it and
    # those that the band above hands down.
    handed = None
    for b in range(len(bands) - 1, -1, -1):
        runs = bands[b]
        ended = runs.where(F.col("height") <= band).select("tree", "block").join(small_side(above, PATH_ROWS), "tree")
        reaching = ended if handed is None else ended.unionByName(handed)
        reaching = written(reaching.select("tree", "block", "path", *named), "reaching")
        reached = runs.join(small_side(reaching, PATH_ROWS), ["tree", "block"])
        if b == 0:
            return reached
        # Runs below, joined to the node at the foot of this band that contains them;
        # buckets are as wide as the nodes of its level, so each holds one.
        head, width = F.element_at("levels", -1)[0], FAN ** (band * b)
        below = bands[b - 1].where(F.col("height") > band).select(
            F.col("tree").alias("t"), F.col("block").alias("below"), head["lo"].alias("from"), head["hi"].alias("to")
        )
        paths = reached.selectExpr(
            "tree",
            f"inline(transform(levels[0], (n, p) -> named_struct('lo', n.lo, 'hi', n.hi, 'path', {path}{pairs})))",
        )
        bucket = F.floor(F.col("from") / width) == F.floor(F.col("lo") / width)
        contained = (F.col("lo") <= F.col("from")) & (F.col("to") <= F.col("hi"))
        handed = below.join(paths, (F.col("t") == F.col("tree")) & bucket & contained)
        handed = handed.select("tree", F.col("below").alias("block"), "path", *named)
    raise ValueError("no bands")


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of its siblings' hashes up to
    the root, left to right), folded_root (from what is presented and the original
    siblings), verified (it is the root), n_siblings."""
    top, band, path = manifest.top, manifest.band, _path(manifest.band)
    roots = _tops(top, band).select("tree", F.col("digest").alias("root"), F.expr(f"cast(array() AS {_PATH_TYPE}) AS path"))
    of_sources = _descended(top, roots, ["root"], band).selectExpr(
        f"inline(transform(levels[0], (n, p) -> named_struct('tree', n.lo, 'subroot', n.digest, 'root', root, 'path', {path})))"
    )
    runs = _descended(manifest.bands, written(of_sources, "subroots"), ["subroot", "root"], band)
    fold = "aggregate(path, coalesce(shown, leaf), (h, s) -> sha2(cast(concat(s.left, h, s.right) AS binary), 256))"
    rows = runs.selectExpr(
        "subroot", "root",
        "inline(transform(rows, (r, p) -> named_struct('doc_id', r.doc_id, 'shown', r.shown, "
        f"'leaf', levels[0][p].digest, 'path', {path})))",
    )
    joined = F.expr("array_join(transform(path, s -> concat(s.left, s.right)), '')")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", _hashed(joined).alias("proof_sha256"),
        F.expr(fold).alias("folded_root"), (F.length(joined) / 64).cast("bigint").alias("n_siblings"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_ends(docs: DataFrame) -> Column:
    """The text that a careless copy presents: of every other id, by checksum, without
    its line ends."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(tampered, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))
