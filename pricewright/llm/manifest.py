"""Merkle manifest of a table: leaves placed by bitmap ranks, levels reduced over keyed slots.

Each group (a source) keeps its keys as a bitmap of 64-bit words, of which only those with a key exist.  Words are
merged by OR and counted by popcount; a directory of counts, in steps of ``FAN`` words, FAN squared and so on, gives
the number of keys before each word.  A leaf's place is that number plus the popcount of its word below its own bit,
so leaves are never sorted.  Sixteen places form a run; each leaf goes into its slot of the run, and runs become the
leaves of the next level until every group has one node.  The groups' nodes form the last tree in the same way.

Repeated keys are told by words that hold more rows than bits.  Only their rows are counted further: by key, then by
digest in three steps, so that neither one key with many rows nor many equal rows make a large group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.operators.ranking import number_sorted
from pricewright.session import materialise

ARITY = 16  # nodes of a run
FAN = 1024  # words, or nodes of the directory, that one node of the directory counts
_HEX = 64  # characters of a digest
_SALTS = 256  # parts of the rows that have one digest


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: for every field ``-`` if it is null, else its number of UTF-8 bytes, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def _same(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls are equal; the columns ``on`` of the right side go."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    rule = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(other, rule, how).drop(*[f"_r_{c}" for c in on])


def _before(counts: DataFrame, by: list[str], key: str, name: str) -> DataFrame:
    """Adds the sum of ``n`` over the smaller keys of the same group; null keys come first."""
    earlier = Window.partitionBy(*by).orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _directory(words: DataFrame) -> DataFrame:
    """Adds ``base`` to each word (tree, word, n): the rows of its tree in smaller words.

    A window holds at most FAN nodes and one for the null key, whatever the number of words.
    """
    low, high = words.agg(F.min("word"), F.max("word")).first()
    if low is None or high - low < FAN:
        return _before(words, ["tree"], "word", "base")
    step = FAN.bit_length() - 1
    parent = F.shiftright("word", step)
    above = words.groupBy("tree", parent.alias("word")).agg(F.sum("n").alias("n"))
    above = _directory(materialise(above, "directory")).select("tree", F.col("word").alias("_parent"), F.col("base").alias("_above"))
    inside = _before(words.withColumn("_parent", parent), ["tree", "_parent"], "word", "base")
    return _same(inside, above, ["tree", "_parent"]).withColumn("base", F.col("base") + F.col("_above")).drop("_parent", "_above")


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``pos`` to rows (row, tree, key, leaf, ...): the place in the tree by key, then by leaf; null keys come first.

    ``row`` differs from row to row and is stored, so that equal rows share their places the same way in every attempt.
    """
    word, bit = F.shiftright("key", 6), F.col("key").bitwiseAND(63).cast("int")
    # a shift by a column has no function of its own
    placed = rows.withColumn("word", word).withColumn("bit", bit)
    words = placed.groupBy("tree", "word").agg(F.coalesce(F.bit_or(F.expr("shiftleft(1L, bit)")), F.lit(0).cast("long")).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = materialise(words, "bitmap")
    table = _directory(words).withColumn("repeats", F.col("n") > F.bit_count("bits")).drop("n")
    found = _same(placed, table, ["tree", "word"])
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    once = found.where("NOT repeats").withColumn("pos", F.col("base") + below).select(*rows.columns, "pos")
    if not words.where(F.col("n") > F.bit_count("bits")).limit(1).count():
        return once
    again = found.where("repeats").select(*rows.columns, "word", "base")
    again = materialise(again.withColumn("part", F.substring("leaf", 1, 3)).withColumn("salt", F.pmod("row", F.lit(_SALTS))), "repeats")
    total = F.col("base")
    steps = [(["tree", "word"], "key"), (["tree", "key"], "part"), (["tree", "key", "part"], "leaf"), (["tree", "key", "leaf"], "salt")]
    out = again
    for i, (by, key) in enumerate(steps):
        counts = again.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
        out = _same(out, _before(counts, by, key, f"_b{i}").drop("n"), [*by, key])
        total = total + F.col(f"_b{i}")
    own = F.row_number().over(Window.partitionBy("tree", "key", "leaf", "salt").orderBy("row")) - 1
    return once.unionByName(out.withColumn("pos", total + own).select(*rows.columns, "pos"))


def _climb(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """All levels of runs above ``nodes`` (tree, pos, digest, payload).

    A run has its number ``at``, the digests of its slots in a row, its members with their payload (level 0 only) and
    the digest of its node.  A run that is the whole level of its tree and has one member ends the tree: ``ended``.
    """
    levels, slot = [], F.pmod("pos", F.lit(ARITY)).cast("int")
    while True:
        member = F.struct(slot.alias("slot"), "digest", *payload)
        runs = nodes.groupBy("tree", F.floor(F.col("pos") / ARITY).alias("at")).agg(F.collect_list(member).alias("members"))
        keyed = F.map_from_entries(F.transform("members", lambda m: F.struct(m["slot"], m["digest"])))
        runs = runs.withColumn("_slots", keyed)
        runs = runs.withColumn("run", F.array_join(F.transform(F.sequence(F.lit(0), F.size("members") - 1), lambda k: F.element_at("_slots", k)), ""))
        runs = runs.withColumn("ended", (F.col("at") == 0) & (F.size("members") == 1)).withColumn("node", F.when(F.col("ended"), F.col("run")).otherwise(digest(F.col("run"))))
        levels.append(materialise(runs.select("tree", "at", *(["members"] if not levels else []), "run", "ended", "node"), "runs"))
        open_ends = levels[-1].where("NOT ended")
        if not open_ends.limit(1).count():
            return levels
        nodes, payload = open_ends.select("tree", F.col("at").alias("pos"), F.col("node").alias("digest")), []


def _descend(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Runs of level 0 with ``path``, the steps above their node, and what ``top`` (tree, path, ...) says of their tree.

    A step is the slot of a node in its run, and the run.  Every level joins the one above it by run, sixteen rows to
    one, so paths are handed down without a key of many rows.
    """
    others = [c for c in top.columns if c not in ("tree", "path")]
    found = None
    for runs in reversed(levels):
        here = _same(runs.where("ended"), top, ["tree"])
        if found is not None:
            above = found.select("tree", F.col("at").alias("_above"), F.col("run").alias("_run"), F.col("ended").alias("_ended"), "path", *others)
            below = _same(runs.where("NOT ended").withColumn("_above", F.floor(F.col("at") / ARITY)), above, ["tree", "_above"])
            step = F.struct(F.pmod("at", F.lit(ARITY)).cast("int").alias("slot"), F.col("_run").alias("run"))
            path = F.when(F.col("_ended"), F.col("path")).otherwise(F.concat(F.array(step), "path"))
            here = below.withColumn("path", path).select(*here.columns).unionByName(here)
        found = here
    return found


def _members(runs: DataFrame) -> DataFrame:
    """One row per node of level 0, with the whole path from it to the root."""
    rows = runs.withColumn("member", F.explode("members"))
    step = F.array(F.struct(F.col("member.slot").alias("slot"), "run"))
    return rows.withColumn("path", F.when(F.col("ended"), F.col("path")).otherwise(F.concat(step, "path"))).drop("members", "run", "ended", "node")


def proofs(docs: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source", shown: Column | None = None) -> DataFrame:
    """key, group, leaf, shown, subroot, root and ``path`` of every row of ``docs``.

    ``leaf`` is the digest that goes into the tree, ``shown`` the one that somebody presents later (the leaf, unless
    given).  A path lists (slot, run) from the leaf to the root; a run is the digests of its slots in a row.

    A null key comes before all others, a null group before all other groups.  Rows of one key are placed by leaf,
    equal rows in any order.  Null and very long fields are what ``leaf_digest`` says.  An empty table gives no
    rows.  Columns other than those of the expressions are ignored, whatever their names.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(group).alias("tree"), F.col(key).cast("long").alias("key"),
                       leaf.alias("leaf"), (leaf if shown is None else shown).alias("shown"))
    rows = materialise(rows, "leaves")
    levels = _climb(ranked(rows).withColumn("digest", F.col("leaf")), ["key", "shown"])
    ends = reduce(DataFrame.unionByName, [r.where("ended").select("tree", F.col("node").alias("digest")) for r in levels])
    ends = materialise(ends, "subroots")
    numbers = number_sorted(ends.select(F.col("tree").alias("name")), "name", "pos")
    groups = _same(ends.withColumnRenamed("tree", "name"), numbers, ["name"]).withColumn("tree", F.lit(0))
    above = _climb(groups, ["name"])
    steps = "array<struct<slot:int,run:string>>"
    ending = above[-1].where("ended").select("tree", F.array().cast(steps).alias("path"), F.col("node").alias("root"))
    top = _members(_descend(above, ending)).select(F.col("member.name").alias("tree"), "path", F.col("member.digest").alias("subroot"), "root")
    found = _members(_descend(levels, materialise(top, "top")))
    return found.select(F.col("member.key").alias("key"), F.col("tree").alias("group"), F.col("member.digest").alias("leaf"), F.col("member.shown").alias("shown"), "subroot", "root", "path")


def _sides(step: Column) -> tuple[Column, Column]:
    cut = step["slot"] * _HEX
    return F.substring(step["run"], F.lit(1), cut), F.substring(step["run"], cut + _HEX + 1, F.lit(ARITY * _HEX))


def siblings(path: Column) -> Column:
    """The digests that a proof needs, in a row: the others of each run, from the leaf to the root."""
    return F.array_join(F.transform(path, lambda s: F.concat(*_sides(s))), "")


def folded(path: Column, start: Column) -> Column:
    """The root that follows from a digest and the siblings of a path."""
    def up(node: Column, step: Column) -> Column:
        left, right = _sides(step)
        return digest(F.concat(left, node, right))
    return F.aggregate(path, start, up)
