"""Line dedup by a tree of line templates, in DataFrame operations only.

A line's tokens are cut at white space, and a token with a digit is a field `<*>`. The tree has fixed depth: a line
belongs to the leaf of its token count and its leading tokens. Within a leaf the distinct lines are grouped in three
ways, so that a line may have several templates, its tokens with fields generalised:

* whole leaf: a position that takes at least `min_values` different tokens is a field of all its lines;
* rare tokens: a position is a field of a line if fewer than `min_values` lines have its token there, so unlike lines
  that came into the leaf hide nothing;
* one field: a position is a field of lines that agree in all others, if there are at least `min_values` of them,
  however common the tokens are that it takes.

A template recurs if lines of it are in at least `min_docs` documents. One with fields counts only if constants hold
behind the leading tokens: at least two, and at least half; a line that recurs token by token needs a constant token
only. Lines of a recurring template are dropped from all documents but the first that has it; a line of several
recurring templates stays only in the earliest of their first documents.

The tree is built from hashes of (leaf, line): a leaf with too few distinct lines to have a field is left out before any
token is looked at. Texts are moved once, for the final join, and the lines of the other leaves for their tokens, of
which each is a row of hashes: work grows with the number of tokens, whatever the size of a leaf. A line that a third of
all documents share is one row for each of them with a hash and its positions; its counts are partially aggregated and
its join back is one that adaptive execution can split.

Defined results: a null or empty text has one blank line and stays as it is; blank lines are never dropped; a document
is its id and text, so repeated rows are one document and are changed alike; a null id counts as a document after all
others; equal lines of one document are one occurrence and are kept or dropped together; an empty table gives no rows;
columns that are named like helpers (`_...`) don't clash, as only id and text are used to find the lines. Texts of any
length are taken whole.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import checkpointed, packed, unpacked

LEADING = 3
MIN_DOCS = 3
MIN_VALUES = 3
FIELD = "<*>"
#: Bits of the filter of leaves that is sent to every task, whatever their number.
FILTER_BITS = 1 << 20

_DIGITS = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
#: White space of a line other than spaces, and with its longer runs.
_ODD = r"[\x09\x0B-\x0D]"
_SPACES = r"\x20[\x20\x09\x0B-\x0D]++|[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*+"


def _spaced(text: Column) -> Column:
    """Runs of white space inside lines as one space; most texts have none to change."""
    return F.when(text.contains("  ") | text.rlike(_ODD), F.regexp_replace(text, _SPACES, " ")).otherwise(text)


def _masked(line: Column) -> Column:
    """Tokens with digits as fields."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _DIGITS, FIELD)).otherwise(line)


def _leaf(line: str = "line") -> Column:
    count = F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(" "))) + 1
    return F.xxhash64(count, F.substring_index(line, " ", LEADING))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, hash of the text, and text, null texts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(whole).alias("th"), whole.alias("text"))


def _exploded(keyed: DataFrame) -> DataFrame:
    lines = keyed.select("id", "th", F.posexplode(F.split(_spaced(F.col("text")), "\n", -1)).alias("pos", "line"))
    lines = lines.select("id", "th", "pos", F.trim(_masked(F.col("line"))).alias("line")).where("line <> ''")
    return lines.select("id", "th", "pos", "line", _leaf().alias("leaf"), F.xxhash64("line").alias("h"))


def _maybe_in(leaves: DataFrame) -> Column:
    """False for most leaves that are not among `leaves`: a bitmap of fixed size, sent along with the code."""
    bit = F.pmod("leaf", F.lit(FILTER_BITS))
    words = leaves.groupBy(F.expr(f"pmod(leaf, {FILTER_BITS}) div 64").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(leaf, {FILTER_BITS}) % 64 as int))")).alias("bits"))
    held = [0] * (FILTER_BITS // 64)
    for row in words.collect():
        held[row["word"]] = row["bits"]
    array = F.from_json(F.lit(json.dumps(held)), "array<bigint>")
    word = F.element_at(array, (F.floor(bit / 64) + 1).cast("int"))
    return F.call_function("shiftright", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _fields(found: DataFrame, min_values: int) -> DataFrame:
    """(leaf, h, fields): sets of positions that are fields of a line, by each of the three ways of grouping."""
    tokens = found.select("leaf", "h", "whole", F.posexplode("tokens").alias("at", "token")).withColumn("token", F.xxhash64("at", "token"))
    # `others` stands for all tokens of the line but this one.
    tokens = tokens.select("leaf", "h", "at", "token", F.col("whole").bitwiseXOR(F.col("token")).alias("others"))
    values = checkpointed(tokens.groupBy("leaf", "at", "token").count())
    of_leaf = values.groupBy("leaf", "at").count().where(F.col("count") >= min_values).groupBy("leaf").agg(F.collect_list("at").alias("fields"))
    by_leaf = found.select("leaf", "h").join(of_leaf, "leaf")
    rare = tokens.join(values.where(F.col("count") < min_values), ["leaf", "at", "token"], "left_semi")
    by_rare = rare.groupBy("leaf", "h").agg(F.collect_list("at").alias("fields"))
    inner = tokens.where(F.col("at") >= LEADING)
    alike = inner.groupBy("leaf", "at", "others").count().where(F.col("count") >= min_values)
    by_one = inner.join(alike, ["leaf", "at", "others"], "left_semi").select("leaf", "h", F.array("at").alias("fields"))
    return by_leaf.union(by_rare).union(by_one)


def _generalised(keyed: DataFrame, lines: DataFrame, min_values: int) -> DataFrame:
    """(h, template): hashes of the templates with fields, of lines in leaves that may have them, where enough constants hold."""
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_values).select("leaf")
    leaves = checkpointed(leaves)
    # Only lines of these leaves, and few others, leave the tasks that read them.
    found = _exploded(keyed).where(_maybe_in(leaves)).groupBy("leaf", "h").agg(F.first("line").alias("line"))
    found = found.join(leaves, "leaf", "left_semi").select("leaf", "h", F.split("line", " ").alias("tokens"))
    # Made once a line and written with it, as a value beside exploded tokens is made once a token.
    whole = F.aggregate(F.transform("tokens", lambda token, at: F.xxhash64(at, token)), F.lit(0).cast("long"), lambda all_, one: all_.bitwiseXOR(one))
    found = checkpointed(found.withColumn("whole", whole))
    of_line = found.join(_fields(found, min_values), ["leaf", "h"])
    template = F.transform("tokens", lambda token, at: F.when(F.array_contains("fields", at), FIELD).otherwise(token))
    of_line = of_line.select("h", template.alias("t"))
    constants = F.size(F.filter(F.slice("t", LEADING + 1, F.greatest(F.size("t") - LEADING, F.lit(0))), lambda token: token != FIELD))
    enough = (constants >= 2) & (2 * constants >= F.size("t") - LEADING)
    return of_line.where(enough).select("h", F.xxhash64(F.array_join("t", " ")).alias("template")).distinct()


def _dropped(docs: DataFrame, doc_id: str, text: str, min_docs: int, min_values: int) -> DataFrame:
    """(id, th, places): for each document with dropped lines their sorted positions, from 0."""
    keyed = _keyed(docs, doc_id, text)
    found = _exploded(keyed).withColumn("constant", F.expr(f"replace(replace(line, '{FIELD}', ''), ' ', '') <> ''"))
    seen = checkpointed(found.select("id", "th", "pos", "leaf", "h", "constant"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("th").alias("th"))
    once = seen.groupBy("id", "th", "leaf", "h", "constant").agg(F.lit(1).alias("one"))
    lines = checkpointed(once.groupBy("leaf", "h", "constant").agg(F.count("*").alias("docs"), F.min(order).alias("first")))
    templates = checkpointed(_generalised(keyed, lines, min_values))
    by_template = seen.join(templates, "h").groupBy("template", "id", "th").agg(F.lit(1).alias("one"))
    by_template = by_template.groupBy("template").agg(F.count("*").alias("n"), F.min(order).alias("f")).where(F.col("n") >= min_docs)
    general = templates.join(by_template, "template").groupBy("h").agg(F.min("f").alias("f"))
    exact = lines.where((F.col("docs") >= min_docs) & F.col("constant")).select("h", F.col("first").alias("e"))
    # A template's first document is at or before the line's own.
    firsts = exact.join(general, "h", "full").select("h", F.coalesce("f", "e").alias("f"))
    gone = seen.join(firsts, "h").where(~(F.col("id").eqNullSafe(F.col("f.id")) & (F.col("th") == F.col("f.th"))))
    return gone.groupBy("id", "th").agg(F.array_sort(F.collect_set("pos")).alias("places"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_values: int = MIN_VALUES, counted: bool = True) -> DataFrame:
    """`docs` with the dropped lines out of the text, and `n_dropped`; if not `counted`, the columns of `docs` alone."""
    gone = _dropped(docs, doc_id, text, min_docs, min_values).select(F.col("id").alias("of_id"), F.col("th").alias("of_th"), "places")
    # Packed, so that no column of `docs` meets a helper's name.
    rows, own = packed(docs, id=F.col(doc_id), th=F.xxhash64(F.coalesce(F.col(text), F.lit("")))), F.col(f"row.`{text}`")
    rows = rows.join(gone, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("th") == F.col("of_th")), "left")
    # What lies between dropped positions is kept as slices.
    rows = rows.withColumn("lines", F.when(F.col("places").isNotNull(), F.split(own, "\n", -1)))
    rows = rows.withColumn("cuts", F.when(F.col("places").isNotNull(), F.concat(F.array(F.lit(-1)), "places", F.array(F.size("lines")))))
    parts = F.transform(
        F.arrays_zip(F.slice("cuts", 1, F.size("cuts") - 1).alias("a"), F.slice("cuts", 2, F.size("cuts") - 1).alias("b")),
        lambda gap: F.slice("lines", gap["a"] + 2, gap["b"] - gap["a"] - 1),
    )
    left = F.when(F.col("places").isNotNull(), F.array_join(F.flatten(parts), "\n")).otherwise(own)
    if not counted:
        return unpacked(rows, docs.columns, **{text: left})
    n_dropped = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    return unpacked(rows, [*[c for c in docs.columns if c != "n_dropped"], "n_dropped"], **{text: left, "n_dropped": n_dropped})


def report(docs: DataFrame) -> DataFrame:
    """The registered query's rows."""
    return dedup(docs.select("doc_id", "text")).select("doc_id", "n_dropped", "text")


def oracle(docs: str = "documents") -> str:
    """The same rows in DuckDB's SQL, for ids that don't repeat."""
    return f"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM {docs})),
    t AS (SELECT *, regexp_extract_all(regexp_replace(raw, '[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*', '{FIELD}', 'g'), '[^\\x20\\x09-\\x0D]+') AS w FROM l),
    s AS (SELECT *, array_to_string(w, ' ') AS line, len(w) || ' ' || array_to_string(w[1:{LEADING}], ' ') AS leaf FROM t WHERE len(w) > 0),
    u AS (SELECT leaf, line, any_value(w) AS w, count(DISTINCT doc_id) AS docs, min(doc_id) AS first FROM s GROUP BY leaf, line),
    o AS (SELECT * FROM u QUALIFY count(*) OVER (PARTITION BY leaf) >= {MIN_VALUES}),
    e AS (SELECT leaf, line, w, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS p FROM o),
    v AS (SELECT leaf, p, token, count(*) AS n FROM e GROUP BY leaf, p, token),
    f AS (SELECT leaf, p FROM v GROUP BY leaf, p HAVING count(*) >= {MIN_VALUES}),
    g AS (SELECT leaf, line, w, fields FROM o JOIN (SELECT leaf, list(p) AS fields FROM f GROUP BY leaf) USING (leaf)
        UNION ALL SELECT leaf, line, any_value(w), list(p) FROM e JOIN v USING (leaf, p, token) WHERE n < {MIN_VALUES} GROUP BY leaf, line
        UNION ALL SELECT leaf, line, w, [p] FROM (SELECT *, count(*) OVER (PARTITION BY leaf, p, w[1:p - 1], w[p + 1:]) AS n FROM e WHERE p > {LEADING}) WHERE n >= {MIN_VALUES}),
    x AS (SELECT leaf, line, list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(fields, i) THEN '{FIELD}' ELSE w[i] END) AS w FROM g),
    y AS (SELECT leaf, line, array_to_string(w, ' ') AS template, len(list_filter(w[{LEADING + 1}:], lambda v: v <> '{FIELD}')) AS c, len(w) AS n FROM x),
    z AS (SELECT DISTINCT leaf, line, template FROM y WHERE c >= 2 AND 2 * c >= n - {LEADING}),
    r AS (SELECT template, min(doc_id) AS first FROM s JOIN z USING (leaf, line) GROUP BY template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
    q AS (SELECT leaf, line, min(r.first) AS first FROM z JOIN r USING (template) GROUP BY leaf, line),
    d AS (SELECT u.leaf, u.line, coalesce(q.first, u.first) AS first FROM u LEFT JOIN q USING (leaf, line)
        WHERE q.first IS NOT NULL OR (u.docs >= {MIN_DOCS} AND replace(replace(u.line, '{FIELD}', ''), ' ', '') <> '')),
    k AS (SELECT s.doc_id, s.pos FROM s JOIN d USING (leaf, line) WHERE s.doc_id <> d.first),
    n AS (SELECT doc_id, count(*) AS n FROM k GROUP BY doc_id),
    j AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN k USING (doc_id, pos) GROUP BY doc_id)
    SELECT o.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_dropped, CASE WHEN n.n IS NULL THEN o.text ELSE coalesce(j.text, '') END AS text
    FROM {docs} o LEFT JOIN n USING (doc_id) LEFT JOIN j USING (doc_id)"""
