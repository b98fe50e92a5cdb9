"""A Merkle manifest of a dataset: rows are the leaves of a tree of threes for each source, whose roots are the leaves of
one more tree. Blocks of leaves collapse in higher-order functions; the roots of blocks are the next round's leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, written

#: Nodes that make one parent.
FAN = 3
#: Levels that a block collapses at most; its size is bounded by FAN ** LEVELS.
LEVELS = 6
BLOCK = FAN**LEVELS

_STEPS = [FAN**k for k in range(LEVELS)]
_PATH = "array<struct<l:string,r:string>>"


def digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields, each `-` if null, else its length in bytes, `:` and itself."""
    as_text = [x.cast("string") for x in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in as_text]), 256)


def _hashed(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _parents(nodes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), lambda k: _hashed(F.slice(nodes, k * FAN + 1, FAN)))


def _ranked(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`nodes` with `_i`, the place in its group from 0, and `_n`, the group's rows.

    Rows are sorted by range, so a hot group lies in many tasks, and are written with the number of their task and
    their place in it. What precedes a task's part of a group is a running sum over one row for each part."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = nodes.repartitionByRange(tasks, group, *order).sortWithinPartitions(group, *order)
    # The upper bits of such an id are the task, the lower 33 the row in it.
    laid = written(laid.withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumns({"_task": F.shiftrightunsigned("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")
    parts = laid.groupBy(group, "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    above = F.sum("_rows").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(group, "_task", (F.coalesce(above, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("_n"))
    return laid.join(parts, [group, "_task"]).withColumn("_i", F.col("_row") + F.col("_shift")).drop("_task", "_row", "_shift")


def _rounds(ranked: DataFrame, group: str, carried: list[str]) -> list[DataFrame]:
    """Tables of blocks, one for each round: group, `_block`, `_n` (nodes of the group in this round), `_rows` (what is
    carried, in order) and `_levels` (the nodes, their parents and so on). A group with one block ends with its
    root; another's blocks collapse all levels and their roots are its nodes in the next round."""
    rounds = []
    while True:
        node = F.struct("_i", "leaf", *carried)
        blocks = ranked.groupBy(group, F.floor(F.col("_i") / BLOCK).alias("_block"), "_n").agg(F.sort_array(F.collect_list(node)).alias("_nodes"))
        steps = F.filter(F.array(*map(F.lit, _STEPS)), lambda x: x < F.col("_n"))
        leaves = F.transform("_nodes", lambda x: x["leaf"])
        levels = F.aggregate(steps, F.array(leaves), lambda acc, _: F.concat(acc, F.array(_parents(F.element_at(acc, -1)))))
        kept = F.transform("_nodes", lambda x: F.struct(*[x[c].alias(c) for c in carried])) if carried else F.lit(None)
        rounds.append(blocks := written(blocks.select(group, "_block", "_n", kept.alias("_rows"), levels.alias("_levels"))))
        more = blocks.where(F.col("_n") > BLOCK)
        if more.isEmpty():
            return rounds
        ranked, carried = more.select(group, F.col("_block").alias("_i"), F.ceil(F.col("_n") / BLOCK).alias("_n"), _root().alias("leaf")), []


def _root() -> Column:
    return F.element_at(F.element_at("_levels", -1), 1)


def _path(levels: Column, i: Column) -> Column:
    """The siblings of the i-th node and of its ancestors in the block, those on the left and those on the right."""

    def siblings(nodes: Column, level: Column) -> Column:
        at = F.floor(i / F.element_at(F.array(*map(F.lit, _STEPS)), level + 1)).cast("int")
        k = at % FAN
        return F.struct(F.array_join(F.slice(nodes, at - k + 1, k), "").alias("l"), F.array_join(F.slice(nodes, at + 2, FAN - 1 - k), "").alias("r"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), siblings)


def _above(rounds: list[DataFrame], group: str, tops: DataFrame) -> DataFrame:
    """group, `_block`, `_up` and what else `tops` has: for each block of the first round what lies above its root.
    `tops` has, by group, `_up` as it is above the group's root."""
    ups = None
    for level in range(len(rounds) - 1, -1, -1):
        ended = rounds[level].where(F.col("_n") <= BLOCK).select(group, "_block").join(tops, group)
        if ups is not None:
            others = [c for c in tops.columns if c not in (group, "_up")]
            held = rounds[level + 1].join(ups, [group, "_block"])
            paths = F.transform(F.element_at("_levels", 1), lambda _, i: F.concat(_path(F.col("_levels"), i), F.col("_up")))
            held = held.select(group, F.col("_block").alias("_b"), *others, F.posexplode(paths).alias("_p", "_up"))
            ended = ended.unionByName(held.select(group, (F.col("_b") * BLOCK + F.col("_p")).alias("_block"), "_up", *others))
        ups = ended
    return ups


def _roots(rounds: list[DataFrame], *columns: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [x.where(F.col("_n") <= BLOCK).select(*columns, _root().alias("leaf")) for x in rounds])


def manifest(rows: DataFrame, key: str = "doc_id", source: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tampered: dict[str, Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    A leaf is the digest of `fields`. A source's leaves ascend by `key`, null first; rows that share a key are ordered by
    leaf, and equal rows are a leaf each. A null source is a source, before all others; sources are ordered by their
    UTF-8 bytes. `tampered` gives columns in place of fields where it is not null: the root is folded from that leaf
    along the proof. An empty table gives an empty one, other columns are not looked at."""
    told = [F.col(f"`{c}`") for c in fields]
    changed = {c: F.coalesce(x, F.col(f"`{c}`")) for c, x in (tampered or {}).items()}
    touched = reduce(lambda a, b: a | b, [x.isNotNull() for x in (tampered or {}).values()], F.lit(False))
    other = F.when(touched, digest(*[changed.get(c, x) for c, x in zip(fields, told)]))
    # Null sorts first, as '' does before 's...'.
    group = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit(""))
    leaves = written(rows.select(F.col(f"`{key}`").alias("key"), group.alias("_group"), digest(*told).alias("leaf"), other.alias("_other"), F.monotonically_increasing_id().alias("_salt")))
    # The last order column only lets many equal rows lie in many tasks.
    ranked = _ranked(leaves, "_group", ["key", "leaf", "_salt"])
    rounds = _rounds(ranked, "_group", ["key", "_other"])
    tops = _ranked(_roots(rounds, "_group").withColumn("_all", F.lit("")), "_all", ["_group"])
    top_rounds = _rounds(tops, "_all", ["_group"])
    root = (_roots(top_rounds).first() or [""])[0]
    empty = F.lit(None).cast(_PATH)
    none = top_rounds[0].select("_all").distinct().withColumn("_up", F.coalesce(empty, F.array().cast(_PATH)))
    held = top_rounds[0].join(_above(top_rounds, "_all", none), ["_all", "_block"])
    sources = held.select(F.inline(F.transform("_rows", lambda x, i: F.struct(x["_group"].alias("_group"), F.element_at(F.element_at("_levels", 1), i + 1).alias("subroot"), F.concat(_path(F.col("_levels"), i), F.col("_up")).alias("_up")))))
    held = rounds[0].join(_above(rounds, "_group", sources), ["_group", "_block"])

    def proven(row: Column, i: Column) -> Column:
        leaf = F.element_at(F.element_at("_levels", 1), i + 1)
        whole = F.array(F.concat(_path(F.col("_levels"), i), F.col("_up")))
        # A path is made once and used twice.
        both = F.transform(whole, lambda path: F.struct(_hashed(F.transform(path, lambda s: F.concat(s["l"], s["r"]))).alias("proof"), F.aggregate(path, F.coalesce(row["_other"], leaf), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256)).alias("folded")))[0]
        return F.struct(row["key"].alias(key), leaf.alias("leaf"), both["proof"].alias("proof_sha256"), both["folded"].alias("folded_root"))

    out = held.select("subroot", F.inline(F.transform("_rows", proven)))
    out = out.select(key, "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))
    result = written(out)
    dropped(leaves, ranked, tops, *rounds, *top_rounds)
    return result
