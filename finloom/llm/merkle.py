"""Merkle manifest of a dataset: leaves in order within groups, trees of FAN children, an inclusion proof and its check per row.

Window-based levels. Nodes are partitioned by group and parent index; an ordered full-frame collect_list gives each node the run
it stands in, which is both the parent's preimage and the node's siblings. Parents are deduplicated, written to the shared folder
and form the next level; each level has an eighth of the rows. Proofs are then carried down: a node's path is its own siblings
before its parent's path, so the levels join at 1 + 1/8 + 1/64 ... times the leaves, and texts are read once and never shuffled.

A leaf's index in its group comes from a distributed sort: rows are ordered by range over the cluster, and each sorted part's
first row and count per group give the offset of the rows in it. No group is ever in one task, however many rows it has.

Defined results: any column may be null (its field is `-`; the null group comes before all others, a null id before other ids);
empty and long texts are hashed whole; rows of the same id are ordered by their leaf, and rows equal in all fields are leaves of
their own with equal digests and neighbouring indexes; an empty table has no rows and no root. Further columns pass through
manifest() unless they bear one of its own names (NAMES).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.llm.common import few, settle

#: Children of a node.
FAN = 8
#: Fields of a leaf, in order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Columns that manifest() adds or works with.
NAMES = ["grp", "idx", "n", "depth", "digest", "path", "subroot", "root", "at", "part"]
#: The parts of a sorted table for which offsets are broadcast; beyond it they are joined.
MOST_PARTS = 200_000


def field(value: Column) -> Column:
    """`-` for null, else the value's UTF-8 byte count, a colon and the value."""
    written = value.cast("string")
    return F.when(written.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written))


def leaf(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields."""
    return F.sha2(F.concat(*(field(x) for x in fields)), 256)


def group_key(value: Column) -> Column:
    """A key without nulls in the order of values: null first, then bytewise."""
    written = value.cast("string")
    return F.when(written.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), written))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with idx (from 0, within group, by order) and n (rows of the group).

    The sorted table is written once, with the place of each row in its part, so later reads agree on the order.
    """
    held = settle(rows.orderBy(group, *order).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    held = held.withColumn("part", F.shiftright("at", 33))
    parts = held.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    all_parts, so_far = Window.partitionBy(group), Window.partitionBy(group).orderBy("part")
    offsets = parts.select(group, "part", "first", (F.sum("m").over(so_far) - F.col("m")).alias("before"), F.sum("m").over(all_parts).alias("n"))
    placed = held.join(few(offsets, MOST_PARTS), [group, "part"])
    return placed.withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def runs(nodes: DataFrame) -> DataFrame:
    """nodes (grp, idx, digest) with up (the parent's index), parent (its digest), before and after (the siblings on either side)."""
    up = F.floor(F.col("idx") / FAN).cast("long")
    frame = Window.partitionBy("grp", "up").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = nodes.withColumn("up", up).withColumn("run", F.collect_list("digest").over(frame))
    place = (F.col("idx") % FAN).cast("int")
    sides = {
        "parent": F.sha2(F.array_join("run", ""), 256),
        "before": F.array_join(F.slice("run", 1, place), ""),
        "after": F.array_join(F.slice("run", place + 2, FAN), ""),
    }
    return rows.withColumns(sides).drop("run")


def tree(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The top of each group (grp, idx, digest, n, depth) and the levels below it, lowest first.

    nodes: grp, idx, digest, n. A level holds the nodes of groups with several nodes there; a group of one node is its own top.
    """
    slim = nodes.select("grp", "idx", "digest", "n", F.lit(0).alias("depth"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    here, levels = slim, []
    while most > 1:
        going = (nodes if not levels else here).where("n > 1")
        parents = runs(going.select("grp", "idx", "digest", "n")).select("grp", F.col("up").alias("idx"), F.col("parent").alias("digest"), F.ceil(F.col("n") / FAN).alias("n")).distinct()
        levels.append(going)
        here = settle(parents.withColumn("depth", F.lit(len(levels))).unionByName(here.where("n = 1")), f"merkle-level-{len(levels)}", slim=True)
        most = -(-most // FAN)
    return here, levels


def climbed(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame | None:
    """The lowest level's rows with path and the carried columns of their group's top; tops: grp, idx, depth, path, carried."""
    above, rows = None, None
    for depth in range(len(levels), 0, -1):
        done = tops.where(F.col("depth") == depth).select("grp", "idx", "path", *carried)
        above = done if above is None else done.unionByName(above)
        parents = above.select("grp", F.col("idx").alias("up"), F.col("path").alias("rest"), *carried)
        step = F.array(F.struct("before", "after"))
        rows = runs(levels[depth - 1]).join(parents, ["grp", "up"]).withColumn("path", F.concat(step, "rest")).drop("up", "rest", "parent", "before", "after")
        above = rows.select("grp", "idx", "path", *carried)
    return rows


def manifest(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (grp, digest, the order columns and any others) with idx, path (siblings up to the root), subroot and root."""
    nodes = numbered(rows, "grp", order)
    tops, levels = tree(nodes)
    subroots = settle(tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest", F.col("depth").alias("of"), F.col("idx").alias("at_idx")), "merkle-subroots", slim=True)
    subroots = numbered(subroots, "grp", ["key"])
    apex, upper = tree(subroots)
    top = apex.first()
    root = F.lit(top.digest if top else None).cast("string")
    empty = F.array().cast("array<struct<before:string,after:string>>")
    named = apex.select("grp", "idx", "depth", empty.alias("path"))
    placed = climbed(upper, named, []) if upper else subroots.withColumn("path", empty)
    heads = placed.select(F.col("key").alias("grp"), F.col("at_idx").alias("idx"), F.col("of").alias("depth"), "path", F.col("digest").alias("subroot"))
    heads = settle(heads, "merkle-heads", slim=True)
    alone = nodes.where("n = 1").join(heads.where("depth = 0").select("grp", "path", "subroot"), "grp")
    many = climbed(levels, heads, ["subroot"])
    out = alone if many is None else many.unionByName(alone)
    return out.withColumn("root", root)


def siblings(path: Column) -> Column:
    """The proof as text: each level's siblings from left to right, from the leaf upwards."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def audit(docs: DataFrame) -> DataFrame:
    """A manifest of documents by language, and for each row a check of its proof: rows that are tampered with must fail.

    Where 3 divides crc32 of the decimal doc_id, the checked row's text has its A-Z lower-cased.
    """
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = leaf([F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    own = leaf([F.col(c) for c in FIELDS])
    rows = docs.select("doc_id", group_key(F.col("lang")).alias("grp"), own.alias("digest"), F.when(changed, tampered).alias("tampered"))
    held = settle(rows, "merkle-leaves")
    out = manifest(held, ["doc_id", "digest"]).withColumn("folded_root", folded(F.coalesce("tampered", "digest"), F.col("path")))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels that the SQL twin spells out: FAN ** SQL_LEVELS leaves per group.
SQL_LEVELS = 7


def _levels(start: str, prefix: str) -> str:
    """CTEs of one tree over start (grp, idx, digest, n): level k+1 from level k by grouping, then paths from the top downwards."""
    out = [f"{prefix}0 as (select grp, idx, digest, n, 0 as depth from {start})"]
    for k in range(SQL_LEVELS):
        out.append(
            f"{prefix}{k + 1} as (select grp, idx // {FAN} as idx, sha256(string_agg(digest, '' order by idx)) as digest, (any_value(n) + {FAN - 1}) // {FAN} as n, {k + 1} as depth from {prefix}{k} where n > 1 group by grp, idx // {FAN})"
        )
    return ", ".join(out)


def _steps(prefix: str) -> str:
    """CTEs that give each node of each level its siblings, by one self-join per level."""
    out = []
    for k in range(SQL_LEVELS):
        pairs = f"from {prefix}{k} x left join {prefix}{k} s on s.grp = x.grp and s.idx // {FAN} = x.idx // {FAN} and s.idx <> x.idx"
        out.append(
            f"{prefix}s{k} as (select x.grp, x.idx, coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx < x.idx), '') as before, coalesce(string_agg(s.digest, '' order by s.idx) filter (s.idx > x.idx), '') as after {pairs} where x.n > 1 group by x.grp, x.idx)"
        )
    return ", ".join(out)


def _joined(prefix: str, alias: str, grp: str, idx: str) -> str:
    return " ".join(f"left join {prefix}s{k} {alias}{k} on {alias}{k}.grp = {grp} and {alias}{k}.idx = {idx} // {FAN**k}" for k in range(SQL_LEVELS))


def oracle_sql() -> str:
    written = lambda c: f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end"
    fields = lambda text: " || ".join(written(text if c == "text" else c) for c in FIELDS)
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))"
    crc = f"xor(list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint), lambda c, b: {step}), 4294967295)"
    siblings_of = lambda a: " || ".join(f"coalesce({a}{k}.before || {a}{k}.after, '')" for k in range(SQL_LEVELS))
    folds, last = [], "start"
    for n, (a, k) in enumerate([("a", k) for k in range(SQL_LEVELS)] + [("b", k) for k in range(SQL_LEVELS)]):
        folds.append(f"f{n} as (select * exclude (acc), case when {a}{k}_before is null then acc else sha256({a}{k}_before || acc || {a}{k}_after) end as acc from {last})")
        last = f"f{n}"
    sides = ", ".join(f"{a}{k}.before as {a}{k}_before, {a}{k}.after as {a}{k}_after" for a in "ab" for k in range(SQL_LEVELS))
    tops = " union all ".join(f"select grp, digest from l{k} where n = 1" for k in range(SQL_LEVELS + 1))
    apex = " union all ".join(f"select digest from u{k} where n = 1" for k in range(SQL_LEVELS + 1))
    return f"""
with own as (
    select doc_id, lang, sha256({fields('text')}) as leaf,
        case when {crc} % 3 = 0 then sha256({fields(f"translate(text, '{UPPER}', '{LOWER}')")}) end as tampered,
        case when lang is null then '' else '=' || lang end as grp
    from documents
), nodes as (
    select *, leaf as digest, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by grp) as n from own
), {_levels('nodes', 'l')}, {_steps('l')},
tops as ({tops}),
subs as (select '' as grp, grp as key, digest, row_number() over (order by grp) - 1 as idx, count(*) over () as n from tops),
{_levels('subs', 'u')}, {_steps('u')}, apex as ({apex}),
start as (
    select doc_id, leaf, subs.digest as subroot, (select digest from apex) as root, sha256({siblings_of('a')} || {siblings_of('b')}) as proof_sha256, {sides}, coalesce(tampered, leaf) as acc
    from nodes join subs on subs.key = nodes.grp {_joined('l', 'a', 'nodes.grp', 'nodes.idx')} {_joined('u', 'b', "''", 'subs.idx')}
), {', '.join(folds)}
select doc_id, leaf, subroot, root, proof_sha256, acc as folded_root, acc = root as verified from {last}
"""
