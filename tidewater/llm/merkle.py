"""Merkle manifest of a dataset, persisted every few levels.

A leaf is any hex digest; the leaves of a group stand in the order of a key.
While a group has several nodes, every two consecutive ones become one (the
last alone, where their number is odd): the SHA-256 of their hex digests one
after another.  What remains is the group's subroot; the subroots in the order
of their groups give the root in the same way.

Checkpoint and recompute: of the 2-ary levels only every ``every``-th is
written.  A node of a written level stands over an aligned subtree of at most
``2**every`` nodes of the written level below.  A proof is extracted downwards:
each aligned subtree is handled once, its missing interior nodes are computed
again from the stored nodes below it, the siblings of all its members are
emitted on top of the siblings of its own root, and the interior nodes are
dropped.  One call of the Python function holds one subtree, so memory is
bounded whatever the size of a group; a group that holds all rows is as many
subtrees as any other rows.

A manifest is a folder:

    leaves          grp, idx, size of the group, the leaf, the order key and carried columns
    level=1, 2, ..  grp, idx, size, digest: level ``i`` stands ``i * every`` levels above
    top             the same for the tree over the subroots, one level after another

Defined cases: a group of one leaf has that leaf as its subroot; an empty
table has no root and no rows; a null group comes first and differs from the
empty one; null keys come first in their group; rows of equal keys stand in
the order of their digests, and repeated rows are separate leaves; a null
digest counts as the empty text; a text of any length is one digest.  Columns
are taken by name, so further ones can't clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import prepare, written

EVERY = 10                  # 2**10 nodes under a stored one
LEVEL = "level={}"
TOP = "top/level={}"


def record_digest(*columns: Column) -> Column:
    """SHA-256 in hex of a record: every column as ``-`` if null, else its
    number of UTF-8 bytes, a colon and its value."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a group of ``size``."""
    return (size - 1).bit_length()


def _levels(nodes: list[str], n: int) -> list[list[str]]:
    """The ``n`` levels above ``nodes``, the nodes themselves first."""
    out = [nodes]
    for _ in range(n):
        at = out[-1]
        out.append([_h(*at[i:i + 2]) for i in range(0, len(at), 2)])
    return out


def indexed(rows: DataFrame, digest: str, order: list[str], path: str) -> DataFrame:
    """Write ``rows`` with their place ``idx`` in their group ``grp`` and the
    group's ``size``, and read them back.

    The rows are sorted by range, cut also inside a group and inside equal
    keys, and numbered within their partition; one row for each partition and
    group carries the places before it."""
    spark = rows.sparkSession
    keys = ["grp", *order, digest, "__row"]
    numbered = (rows.withColumn("__row", F.monotonically_increasing_id())
                .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
                .withColumn("__seq", F.monotonically_increasing_id()))
    numbered.write.parquet(f"{path}-sorted")
    sorted_rows = (spark.read.schema(numbered.schema).parquet(f"{path}-sorted")
                   .withColumn("__part", F.shiftright("__seq", 33)))
    each = sorted_rows.groupBy("grp", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__seq").alias("__first"))
    earlier = Window.partitionBy("grp").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("grp", "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
                       F.sum("__n").over(Window.partitionBy("grp")).alias("size"))
    out = (sorted_rows.join(base, ["grp", "__part"])
           .withColumn("idx", F.col("__seq") + F.col("__shift")).drop("__seq", "__part", "__shift"))
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _climb(nodes: DataFrame, digest: str, done: int, every: int) -> DataFrame:
    """The next written level above ``nodes``, which stand ``done`` levels
    above their leaves."""
    schema = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])

    def subtree(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        size = t["size"][0].as_py()
        up = _levels(t["digest"].to_pylist(), max(0, min(every, height(size) - done)))
        return pa.table([[t["grp"][0].as_py()], [t["idx"][0].as_py() >> every], [size], up[-1]], schema=schema)

    return (nodes.select("grp", "idx", "size", F.col(digest).alias("digest"))
            .groupBy("grp", F.shiftright("idx", every).alias("block"))
            .applyInArrow(subtree, "grp string, idx long, size long, digest string"))


PROOF = "array<struct<side: int, digest: string>>"
_STEPS = pa.list_(pa.struct([("side", pa.int32()), ("digest", pa.string())]))


def _descend(nodes: DataFrame, above: DataFrame, digest: str, done: int, every: int) -> DataFrame:
    """``nodes`` with column ``proof``: the siblings inside their aligned
    subtree, then those of its root in ``above`` (grp, idx, proof, and columns
    that all nodes below take over)."""

    def subtree(t: pa.Table, root: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        levels = _levels(t[digest].to_pylist(), max(0, min(every, height(t["size"][0].as_py()) - done)))
        rest = root["proof"][0].as_py()
        proofs = []
        for i in range(t.num_rows):
            own = []
            for level in levels[:-1]:
                j = i ^ 1
                # a last node alone has no sibling; its digest is hashed again
                own.append({"side": 0, "digest": None} if j >= len(level)
                           else {"side": -1 if j < i else 1, "digest": level[j]})
                i >>= 1
            proofs.append(own + rest)
        taken = [pa.array(root[c].to_pylist()[:1] * t.num_rows, pa.string()) for c in over]
        return pa.table([t[c] for c in kept] + taken + [pa.array(proofs, _STEPS)], names=[*kept, *over, "proof"])

    kept = nodes.columns
    over = [c for c in above.columns if c not in ("grp", "idx", "proof")]
    left = nodes.withColumn("__block", F.shiftright("idx", every))
    right = above.withColumnRenamed("idx", "__block")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema]
                       + [f"`{c}` string" for c in over] + [f"proof {PROOF}"])
    return left.groupBy("grp", "__block").cogroup(right.groupBy("grp", "__block")).applyInArrow(subtree, schema)


class Manifest:
    """A written manifest: ``leaves``, their stored upper ``levels``, the
    stored levels of the tree over the subroots (``top``) and the ``root``
    (None for an empty table)."""

    def __init__(self, path: str, every: int, group: str, names: list[str], leaves: DataFrame,
                 levels: list[DataFrame], top: list[DataFrame]):
        self.path, self.every, self.group, self.names = path, every, group, names
        self.leaves, self.levels, self.top = leaves, levels, top
        row = top[-1].select("digest").first()
        self.root = row.digest if row else None

    def subroots(self) -> DataFrame:
        """(group, subroot) of every group."""
        return self.top[0].select(_group(F.col("name")).alias(self.group), F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """The leaf rows with ``subroot``, ``root`` and ``proof``: an entry
        (side, digest) for each level up to the root, side -1 for a sibling to
        the left, 1 to the right, 0 for none."""
        none = F.array().cast(PROOF).alias("proof")
        at = self.top[-1].select("grp", "idx", none)
        for i in range(len(self.top) - 2, -1, -1):
            at = _descend(self.top[i], at.select("grp", "idx", "proof"), "digest", i * self.every, self.every)
        if len(self.top) == 1:
            at = at.join(self.top[0].drop("size"), ["grp", "idx"])
        # the proof of a group's subroot is the upper end of all proofs below it
        at = at.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("idx"), "proof",
                       F.col("digest").alias("subroot"))
        stored = [self.leaves, *self.levels]
        if len(stored) == 1:                      # one leaf in every group
            at = self.leaves.join(at, ["grp", "idx"])
        for i in range(len(stored) - 2, -1, -1):
            at = _descend(stored[i], at.select("grp", "idx", "proof", "subroot"), "leaf" if i == 0 else "digest",
                          i * self.every, self.every)
        names = {f"__k{i}": c for i, c in enumerate(self.names)}
        return at.select(_group(F.col("grp")).alias(self.group), *[F.col(n).alias(c) for n, c in names.items()],
                         "leaf", "subroot", F.lit(self.root).alias("root"), "proof")


def _key(group: Column) -> Column:
    """The group as a string that is never null and keeps the order, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _group(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 1 << 30))


def _tower(nodes: DataFrame, digest: str, path: str, every: int) -> list[DataFrame]:
    """All written levels above ``nodes``, up to one node a group."""
    spark = nodes.sparkSession
    largest = nodes.agg(F.max("size")).first()[0]
    out, at, done = [], nodes, 0
    while largest is not None and done < height(largest):
        up = _climb(at, digest, done, every)
        where = path.format(len(out) + 1)
        up.write.parquet(where)
        at, digest, done = spark.read.schema(up.schema).parquet(where), "digest", done + every
        out.append(at)
    return out


def build(rows: DataFrame, leaf: str = "leaf", group: str = "group", order: list[str] | str = "id", *,
          path: str | None = None, every: int = EVERY, carry: list[str] | None = None) -> Manifest:
    """Write the manifest of ``rows``, whose column ``leaf`` holds the leaf
    digests, ``group`` the group and ``order`` the key inside it.  Columns
    named in ``carry`` are kept beside the leaves."""
    prepare(rows)
    path = path or scratch_path(rows.sparkSession, "merkle")
    order = [order] if isinstance(order, str) else list(order)
    names = list(dict.fromkeys([*order, *(carry or [])]))
    plain = rows.select(_key(F.col(f"`{group}`")).alias("grp"), F.coalesce(F.col(f"`{leaf}`"), F.lit("")).alias("leaf"),
                        *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(names)])
    # the digests are made once: sorting by range samples its input first
    plain = written(plain, "merkle-leaves")
    leaves = indexed(plain, "leaf", [f"__k{i}" for i in range(len(order))], f"{path}/leaves")
    levels = _tower(leaves, "leaf", f"{path}/{LEVEL}", every)
    subs = levels[-1] if levels else leaves.withColumnRenamed("leaf", "digest")
    subs = subs.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    top = indexed(subs, "digest", ["name"], f"{path}/{TOP.format(0)}")
    return Manifest(path, every, group, names, leaves, levels, [top, *_tower(top, "digest", f"{path}/{TOP}", every)])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    def up(node: Column, s: Column) -> Column:
        both = F.when(s["side"] < 0, F.concat(s["digest"], node)).when(s["side"] > 0, F.concat(node, s["digest"]))
        return F.sha2(F.coalesce(both, node), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256 in hex of the siblings' digests, one after another."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: s["digest"])), 256)


def audit(docs: DataFrame, *, every: int = EVERY, path: str | None = None) -> DataFrame:
    """Build the manifest of ``docs``, extract every row's proof and verify
    it, with ``n_chars`` changed by one where 7 divides the CRC-32 of the
    decimal doc_id (of the empty text, where it is null).

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = docs.select(*[F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")])
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    n_chars = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = rows.select("doc_id", "lang", record_digest(*map(F.col, fields)).alias("leaf"),
                       record_digest(*[n_chars if c == "n_chars" else F.col(c) for c in fields]).alias("checked"))
    manifest = build(rows, "leaf", "lang", "doc_id", path=path, every=every, carry=["checked"])
    out = manifest.proofs().withColumn("folded_root", folded(F.col("checked"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
