"""Merkle manifest of a dataset: a digest of every row, a tree of digests for each source, and one over the sources.

Leaves are ranked within their tree without a task for a whole tree: rows are dealt by ranges of (tree, order), counted
by range, and a row's rank is its place in its range behind the counts of the ranges before it.

Every node is labelled with the interval [lo, hi) of the leaf ranks that it covers, so a node of level k lies in bucket
lo div 16^(k + 1) of the level above. Ancestors are attached, from the root down, by joins on (tree, bucket) with the
parent's interval containing the node's; the siblings of a node are the parent's members whose intervals lie outside its
own, those before it on the left, those after it on the right. No group holds more than `RUN` members, however large a
source is. The levels are written to the shared folder as they are built.

Defined results: a null field is written as `-`; a null source is a tree of its own, first in order; leaves with null or
equal ids are ordered nulls first, then by digest, and repeated rows stay rows; a null id counts as not selected for
tampering; columns that the manifest doesn't name are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import checkpointed

#: Consecutive nodes that share a parent.
RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many, by the CRC of its id, is tampered with for the proof's test.
TAMPER_EVERY = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*values), 256)


def ranked(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`df` with `lo` (place in its tree by `order`, from 0), `hi` and `n` (the tree's size)."""
    # The last key deals out and orders rows that are equal in all others.
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (tree, *order, "_tie")]
    dealt = checkpointed(keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie"))
    dealt = dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33))
    counts = checkpointed(dealt.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")))
    # A tree has as many rows here as ranges hold parts of it.
    before = F.expr(f"sum(_rows) over (partition by {tree} order by _range) - _rows")
    counts = counts.select(tree, "_range", (before - F.col("_first")).alias("_shift"), F.expr(f"sum(_rows) over (partition by {tree})").alias("n"))
    lo = (F.col("_at") + F.col("_shift")).alias("lo")
    return dealt.join(counts, [tree, "_range"]).select(*df.columns, lo, (lo + 1).alias("hi"), "n")


def _is_top() -> Column:
    return (F.col("lo") == 0) & (F.col("hi") == F.col("n"))


def _hex(column: Column) -> Column:
    return F.lower(F.hex(column))


def build(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of parents from the bottom (tree, n, lo, hi, digest, members), and the tops (tree, digest).

    `leaves` have tree, lo, hi, n and digest; their other columns stay with them as members of the first level.
    """
    levels: list[DataFrame] = []
    tops = leaves.where(_is_top()).select("tree", "digest")
    nodes, width = leaves.where(~_is_top()), RUN
    while True:
        own = [c for c in nodes.columns if c not in ("tree", "n", "members")]
        members = F.array_sort(F.collect_list(F.struct("lo", *[c for c in own if c != "lo"])))
        grouped = nodes.groupBy("tree", "n", F.expr(f"lo div {width}").alias("bucket")).agg(members.alias("members"))
        joined = F.concat_ws("", F.transform("members", lambda m: _hex(m["digest"])))
        level = grouped.select(
            "tree", "n", F.col("members")[0]["lo"].alias("lo"), F.element_at("members", -1)["hi"].alias("hi"),
            F.unhex(F.sha2(joined, 256)).alias("digest"), "members",
        )
        level = checkpointed(level)
        if not level.limit(1).count():
            return levels, checkpointed(tops)
        levels.append(level)
        tops = tops.union(level.where(_is_top()).select("tree", "digest"))
        nodes, width = level.where(~_is_top()).drop("members"), width * RUN


def _siblings(members: Column, lo: Column, hi: Column) -> Column:
    """The digests of a parent's members outside [lo, hi): what lies left and what lies right of it."""

    def joined(side: Column) -> Column:
        return F.concat_ws("", F.transform(side, lambda m: _hex(m["digest"])))

    left = F.filter(members, lambda m: m["hi"] <= lo)
    right = F.filter(members, lambda m: m["lo"] >= hi)
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def with_paths(leaves: DataFrame, levels: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """`leaves` with `path`: the siblings beside each of its ancestors and itself, from the bottom to the root.

    `top_paths` (tree, path) goes on from the top of each tree.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level, width = levels[k], RUN ** (k + 2)
        here = level.where(_is_top()).join(top_paths, "tree")
        if above is not None:
            up = above.select(F.col("tree").alias("up_tree"), F.expr(f"lo div {width}").alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("members").alias("up_members"), F.col("path").alias("up_path"))
            inside = (F.col("tree") == F.col("up_tree")) & (F.expr(f"lo div {width}") == F.col("up_bucket")) & (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
            path = F.concat(F.array(_siblings(F.col("up_members"), F.col("lo"), F.col("hi"))), "up_path").alias("path")
            below = level.where(~_is_top()).join(up, inside).select(*level.columns, path)
            here = here.select(*below.columns).union(below)
        above = here
    alone = leaves.where(_is_top()).join(top_paths, "tree").select(*leaves.columns, "path")
    if above is None:
        return alone
    member = above.select("tree", "n", "members", "path", F.explode("members").alias("m"))
    own = [F.col("m")[c].alias(c) if c not in ("tree", "n") else F.col(c) for c in leaves.columns]
    path = F.concat(F.array(_siblings(F.col("members"), F.col("m")["lo"], F.col("m")["hi"])), "path").alias("path")
    return member.select(*own, path).union(alone)


def manifest(docs: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, tree, digest, tampered, subroot, path) of every row, and the root; digests are binary.

    `tampered` is the digest of the row with A-Z of its text lowered, for the rows that are selected, else null.
    """
    fields = [encoded(F.col(c)) for c in FIELDS]
    lowered = [*fields[:-1], encoded(F.translate("text", _UPPER, _LOWER))]
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    # A null source comes first, and no source is a null key.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree")
    rows = docs.select("doc_id", tree, F.unhex(digest(fields)).alias("digest"), F.when(chosen, F.unhex(digest(lowered))).alias("tampered"))
    # Hashed once: dealing by ranges reads its input twice.
    leaves = ranked(checkpointed(rows), "tree", ["doc_id", "digest"])
    levels, tops = build(leaves)
    heads = ranked(tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "tree", ["source"])
    head_levels, root = build(heads)
    found = root.first()
    start = root.select("tree", F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("path"))
    head_paths = with_paths(heads, head_levels, start)
    head_paths = checkpointed(head_paths.select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot")))
    out = with_paths(leaves, levels, head_paths.select("tree", "path"))
    out = out.join(head_paths.select("tree", "subroot"), "tree")
    return out.select("doc_id", "tree", "digest", "tampered", "subroot", "path"), found["digest"].hex() if found else ""


def report(docs: DataFrame) -> DataFrame:
    """The registered query's rows: each leaf's place in the manifest, its proof, and whether a tampered copy passes it."""
    rows, root = manifest(docs)
    leaf, start = _hex(F.col("digest")), _hex(F.coalesce("tampered", "digest"))
    proof = F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    folded = F.aggregate("path", start, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))
    out = rows.select(
        "doc_id", leaf.alias("leaf"), _hex(F.col("subroot")).alias("subroot"), F.lit(root).alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.lit(root))


def oracle(levels: int = 8, top_levels: int = 4) -> str:
    """The same in DuckDB's SQL, for trees of at most 16^levels leaves."""

    def enc(v: str) -> str:
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"

    def tree(name: str, key: str, depth: int) -> list[str]:
        """CTEs name0 (key, r, n, d) ... with what lies left and right of each node among its siblings."""
        out = []
        for k in range(depth):
            run = f"PARTITION BY {key}, r // {RUN} ORDER BY r ROWS BETWEEN"
            out.append(f"""{name}{k}s AS MATERIALIZED (SELECT *, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS (SELECT {key}, r // {RUN} AS r, (max(n) + {RUN - 1}) // {RUN} AS n, sha256(string_agg(d, '' ORDER BY r)) AS d
                FROM {name}{k} WHERE n > 1 GROUP BY {key}, r // {RUN})""")
        tops = " UNION ALL ".join(f"SELECT {key}, d FROM {name}{k} WHERE n = 1" for k in range(depth + 1))
        return [*out, f"{name}_top AS MATERIALIZED ({tops})"]

    crc = "xor(c >> 1, (c & 1) * 3988292384)"
    fields = [f"{c}::VARCHAR" for c in FIELDS]
    plain = " || ".join(enc(f) for f in fields)
    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    tampered = " || ".join(enc(f) for f in [*fields[:-1], low])
    parts = [
        f"""hashed AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS t, sha256({plain}) AS d, sha256({tampered}) AS lowered,
            list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                lambda h, a: list_reduce(list_prepend(xor(h, a), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {crc})) AS crc FROM documents)""",
        """a0 AS MATERIALIZED (SELECT doc_id, t, d, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN lowered ELSE d END AS start,
            row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, d) - 1 AS r, count(*) OVER (PARTITION BY t) AS n FROM hashed)""",
        *tree("a", "t", levels),
        "b0 AS MATERIALIZED (SELECT 0 AS u, t, d, row_number() OVER (ORDER BY t) - 1 AS r, count(*) OVER () AS n FROM a_top)",
        *tree("b", "u", top_levels),
    ]
    # Fold from the leaf to the root; a level that a tree doesn't have has no row.
    previous, columns = "SELECT doc_id, t, d AS leaf, start AS f, '' AS p, r FROM a0", "doc_id, t, leaf"
    for k in range(levels):
        parts.append(f"""fa{k} AS (SELECT {columns}, CASE WHEN s.n > 1 THEN sha256(s.l || q.f || s.g) ELSE q.f END AS f,
            CASE WHEN s.n > 1 THEN q.p || s.l || s.g ELSE q.p END AS p, q.r // {RUN} AS r
            FROM ({previous}) q LEFT JOIN (SELECT t AS st, r AS sr, n, l, g FROM a{k}s) s ON s.st = q.t AND s.sr = q.r)""")
        previous = f"SELECT * FROM fa{k}"
    parts.append(f"heads AS (SELECT q.doc_id, q.t, q.leaf, q.f, q.p, b0.d AS subroot, b0.r FROM ({previous}) q JOIN b0 ON b0.t = q.t)")
    previous, columns = "SELECT * FROM heads", "doc_id, leaf, subroot"
    for k in range(top_levels):
        parts.append(f"""fb{k} AS (SELECT {columns}, CASE WHEN s.n > 1 THEN sha256(s.l || q.f || s.g) ELSE q.f END AS f,
            CASE WHEN s.n > 1 THEN q.p || s.l || s.g ELSE q.p END AS p, q.r // {RUN} AS r
            FROM ({previous}) q LEFT JOIN (SELECT r AS sr, n, l, g FROM b{k}s) s ON s.sr = q.r)""")
        previous = f"SELECT * FROM fb{k}"
    return f"""WITH {", ".join(parts)}
        SELECT q.doc_id, q.leaf, q.subroot, (SELECT d FROM b_top) AS root, sha256(q.p) AS proof_sha256, q.f AS folded_root,
            q.f = (SELECT d FROM b_top) AS verified FROM ({previous}) q"""
