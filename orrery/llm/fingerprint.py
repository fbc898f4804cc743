"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections, in DataFrame functions only.

A paragraph is a line; its leaves are the sentences in it, long ones cut every ``LEAF`` characters. A paragraph's
hash covers its leaves' hashes. A section ends after a paragraph whose hash starts with 0 (so boundaries move with
the content, not with positions), the root covers the sections. Equal roots mean equal texts; where roots differ,
unequal sections, in them unequal paragraphs and in these unequal leaves locate the edit (``located_edits``). A fingerprint is the
root and the ``KEEP`` smallest leaf hashes, whose overlap estimates how alike two texts are.

Cases: a null text is an empty one; an empty text has no leaves and a root of its own, is like an empty text (1)
and unlike any other (0); repeated rows give equal fingerprints; an empty table gives an empty result; other
columns are ignored. In ``with_next``, rows of one doc_id stand in the order of their texts, and rows without an id
stand outside the order: the document after each is the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import texts

LEAF, KEEP, HEX = 240, 128, 8
#: Ids of a bucket within which the next document is sought, and buckets of a bucket of buckets.
BUCKET, FAN = 256, 4096
PIECES = r"[^.!?]{1,%d}[.!?]*|[.!?]+" % LEAF


def add_tree(df: DataFrame, text: str, prefix: str, leaves: bool = False) -> DataFrame:
    """Columns <prefix>root, <prefix>sections, <prefix>paragraphs (hashes) and <prefix>sketch (smallest leaf hashes).

    With ``leaves`` also <prefix>lines, the leaf hashes of each paragraph.
    """
    lines, sums, flat = f"{prefix}lines", f"{prefix}paragraphs", f"{prefix}leaves"
    df = df.withColumn(lines, F.transform(F.split(F.col(text), "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECES), F.lit(0)), F.md5)))
    df = df.withColumn(sums, F.transform(F.col(lines), lambda leaves: F.sha2(F.array_join(leaves, ","), 256)))
    df = df.withColumn(flat, F.transform(F.flatten(F.col(lines)), lambda h: F.substring(h, 1, HEX)))
    chain = F.array_join(F.transform(F.col(sums), lambda h: F.concat(h, F.when(h.startswith("0"), "|").otherwise(","))), "")
    sections = F.transform(F.filter(F.split(chain, r"\|"), lambda s: s != ""), lambda s: F.sha2(s, 256))
    df = df.withColumn(f"{prefix}sections", sections).withColumn(f"{prefix}sketch", F.slice(F.sort_array(F.array_distinct(F.col(flat))), 1, KEEP))
    return df.withColumn(f"{prefix}root", F.sha2(F.array_join(F.col(f"{prefix}sections"), ","), 256)).drop(flat, *([] if leaves else [lines]))


def fingerprint(root: str, sketch: str) -> Column:
    return F.concat(F.col(root), F.lit(":"), F.array_join(F.col(sketch), ""))


def likeness(root_a: str, sketch_a: str, root_b: str, sketch_b: str) -> Column:
    """1 for equal roots, else the share of common ones among the KEEP smallest leaf hashes of both."""
    a, b = F.col(sketch_a), F.col(sketch_b)
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, KEEP)
    common = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when(F.col(root_a) == F.col(root_b), 1.0).when(F.size(least) == 0, 0.0).otherwise(common / F.size(least))


def changed_paragraphs(prefix_a: str, prefix_b: str) -> Column:
    """Hashes of paragraphs of a that b lacks; none where the roots are equal."""
    a, b = F.col(f"{prefix_a}paragraphs"), F.col(f"{prefix_b}paragraphs")
    return F.when(F.col(f"{prefix_a}root") == F.col(f"{prefix_b}root"), F.array().cast("array<string>")).otherwise(F.array_except(a, b))


def _alike_from_start(a: Column, b: Column) -> Column:
    """Number of equal elements at the start of two arrays."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(at == 0, F.least(F.size(a), F.size(b))).otherwise(at - 1).cast("int")


def _alike_at_end(a: Column, b: Column, start: Column) -> Column:
    """Number of equal elements at the end, none of them among the ``start`` first."""
    return F.least(_alike_from_start(F.reverse(a), F.reverse(b)), F.least(F.size(a), F.size(b)) - start)


def _section_starts(paragraphs: Column) -> Column:
    """Index of each section's first paragraph, then the number of paragraphs."""
    ends = F.filter(F.transform(paragraphs, lambda h, i: F.when(h.startswith("0"), i + 1)), lambda i: i.isNotNull())
    return F.concat(F.array(F.lit(0)), ends, F.array(F.size(paragraphs)))


def located_edits(df: DataFrame, key: str, a: str = "a_", b: str = "b_") -> DataFrame:
    """Where two texts of a row differ: one row per edited paragraph, found by descending both trees of ``add_tree`` (with leaves).

    Equal roots end the descent. Else equal sections at either end are passed over, then equal paragraphs at either end of the
    rest. Where the two remainders are equally long, they are compared place by place: ``replaced`` rows name the paragraph's
    index in both texts and its differing leaves, [leaf_from, a_leaf_to) and [leaf_from, b_leaf_to); swapped paragraphs are two
    of them. Otherwise each paragraph one remainder has more often than the other is ``removed`` (from a) or ``inserted`` (in b),
    the last copies being the surplus. Roots that differ give at least one row. Indices count from 0.

    Cases: rows without a text have no tree and give nothing; an empty text is one empty paragraph; repeated rows are answered
    once. A long text's remainders are spread by paragraph, never compared all with all.
    """
    pa, pb = F.col(f"{a}paragraphs"), F.col(f"{b}paragraphs")
    d = df.where(F.col(f"{a}root") != F.col(f"{b}root")).dropDuplicates([key, f"{a}root", f"{b}root"])
    d = d.select(F.col(key), F.sha2(F.concat(f"{a}root", f"{b}root"), 256).alias("_pair"), *[F.col(f"{p}{c}") for p in (a, b) for c in ("sections", "paragraphs", "lines")])
    d = d.withColumn("_head", _alike_from_start(F.col(f"{a}sections"), F.col(f"{b}sections")))
    d = d.withColumn("_tail", _alike_at_end(F.col(f"{a}sections"), F.col(f"{b}sections"), F.col("_head")))
    for p, par in ((a, pa), (b, pb)):
        starts = _section_starts(par)
        d = d.withColumns({f"_{p}lo": F.get(starts, F.col("_head")), f"_{p}hi": F.get(starts, F.size(f"{p}sections") - F.col("_tail"))})
        d = d.withColumn(f"_{p}rest", F.slice(par, F.col(f"_{p}lo") + 1, F.col(f"_{p}hi") - F.col(f"_{p}lo")))
    ra, rb = F.col(f"_{a}rest"), F.col(f"_{b}rest")
    d = d.withColumn("_same", _alike_from_start(ra, rb))
    d = d.withColumn("_end", _alike_at_end(ra, rb, F.col("_same")))
    for p, rest in ((a, ra), (b, rb)):
        d = d.withColumn(f"_{p}mid", F.slice(rest, F.col("_same") + 1, F.size(rest) - F.col("_same") - F.col("_end"))).withColumn(f"_{p}at", F.col(f"_{p}lo") + F.col("_same"))
    ma, mb = F.col(f"_{a}mid"), F.col(f"_{b}mid")

    level = d.where(F.size(ma) == F.size(mb)).select(key, f"{a}lines", f"{b}lines", f"_{a}at", f"_{b}at", F.posexplode(F.arrays_zip(ma.alias("x"), mb.alias("y"))).alias("i", "h")).where("h.x <> h.y")
    level = level.select(key, F.lit("replaced").alias("kind"), (F.col(f"_{a}at") + F.col("i")).alias("a_index"), (F.col(f"_{b}at") + F.col("i")).alias("b_index"), F.col("h.x").alias("a_hash"), F.col("h.y").alias("b_hash"), f"{a}lines", f"{b}lines")
    level = level.withColumns({"_x": F.get(f"{a}lines", F.col("a_index")), "_y": F.get(f"{b}lines", F.col("b_index"))}).withColumn("leaf_from", _alike_from_start(F.col("_x"), F.col("_y")))
    level = level.withColumn("_z", _alike_at_end(F.col("_x"), F.col("_y"), F.col("leaf_from"))).withColumns({"a_leaf_to": F.size("_x") - F.col("_z"), "b_leaf_to": F.size("_y") - F.col("_z")})

    def copies(p: str, side: str) -> DataFrame:
        rows = d.where(F.size(ma) != F.size(mb)).select(key, "_pair", f"_{p}at", F.posexplode(f"_{p}mid").alias("i", "hash"))
        nth = F.row_number().over(Window.partitionBy("_pair", key, "hash").orderBy("i"))
        return rows.select(F.col(key), "_pair", "hash", nth.alias("nth"), (F.col(f"_{p}at") + F.col("i")).alias(f"{side}_index"))

    odd = copies(a, "a").withColumn("_k", F.struct(key)).drop(key).join(copies(b, "b").withColumn("_k", F.struct(key)).drop(key), ["_pair", "_k", "hash", "nth"], "full_outer")
    odd = odd.where(F.col("a_index").isNull() | F.col("b_index").isNull())
    none = F.lit(None).cast("int")
    odd = odd.select(
        F.col(f"_k.{key}").alias(key), F.when(F.col("b_index").isNull(), "removed").otherwise("inserted").alias("kind"), "a_index", "b_index",
        F.when(F.col("b_index").isNull(), F.col("hash")).alias("a_hash"), F.when(F.col("a_index").isNull(), F.col("hash")).alias("b_hash"),
        none.alias("leaf_from"), none.alias("a_leaf_to"), none.alias("b_leaf_to"),
    )
    return level.select(*odd.columns).unionByName(odd)


def next_lower(keys: DataFrame, level: int = 0) -> DataFrame:
    """(k, lower): for distinct keys k the next smaller one, null for the smallest.

    Sought within spans of FAN keys; across spans by the same rule on the spans. The third level, one row for
    FAN ** 2 keys, is the only one ordered in a single task.
    """
    if level == 2:
        return keys.withColumn("lower", F.lead("k").over(Window.orderBy(F.desc("k"))))
    g = keys.withColumn("g", F.floor(F.col("k") / FAN))
    inner = g.withColumn("lower", F.lead("k").over(Window.partitionBy("g").orderBy(F.desc("k"))))
    tops = g.groupBy("g").agg(F.max("k").alias("top"))
    across = next_lower(tops.select(F.col("g").alias("k")), level + 1).join(tops.withColumnRenamed("g", "lower"), "lower").select(F.col("k").alias("g"), "top")
    return inner.join(across, "g", "left").select("k", F.coalesce("lower", "top").alias("lower"))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` with next_<column> of the document after it in descending doc_id, after the last of the first.

    Documents are dealt once, by spans of BUCKET ids; each is followed within its span, and the last of a span by
    the top document of the span below, which alone moves again. ``text`` is among ``carried`` and never null.
    """
    bucket = F.floor(F.col("doc_id") / BUCKET)
    spans = docs.where("doc_id is not null").select(bucket.alias("k")).distinct()
    highest = spans.agg(F.max("k").alias("highest"))
    below = next_lower(spans).crossJoin(highest).select(F.col("k").alias("bucket"), F.coalesce("lower", "highest").alias("k"))  # one row on the right
    order = Window.partitionBy("bucket").orderBy(F.desc("doc_id"), "text")
    dealt = docs.where("doc_id is not null").withColumn("bucket", bucket)
    dealt = dealt.withColumns({"at": F.row_number().over(order), **{f"next_{c}": F.lead(c).over(order) for c in carried}})
    heads = dealt.where("at = 1").select(F.col("bucket").alias("k"), F.struct(*carried).alias("head"))
    out = dealt.join(heads.join(below, "k").drop("k"), "bucket", "left")
    out = out.select(*docs.columns, *(F.when(F.col("next_text").isNull(), F.col(f"head.{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in carried))
    first = heads.join(highest, F.col("k") == F.col("highest")).select("head")
    loose = docs.where("doc_id is null").join(first, F.lit(True), "left").select(*docs.columns, *(F.coalesce(F.col(f"head.{c}"), F.col(c)).alias(f"next_{c}") for c in carried))
    return out.unionByName(loose)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, whose last half is the start of the next document."""
    rows = add_tree(texts(docs), "text", "").drop("paragraphs", "sections")
    rows = with_next(rows, ["text", "root", "sketch"])
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.withColumn("n_chars", n.cast("long")).drop("text", "next_text")
    rows = add_tree(rows, "edited", "edited_")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("root", "sketch").alias("fingerprint"),
        fingerprint("edited_root", "edited_sketch").alias("edited_fingerprint"), likeness("root", "sketch", "edited_root", "edited_sketch").alias("near_edited"),
        likeness("root", "sketch", "next_root", "next_sketch").alias("near_next"),
    )


def _tree_sql(source: str, text: str, p: str, keep: str) -> str:
    """The tree of column ``text`` of ``source`` as a chain of selects."""
    lines = f"list_transform(string_split({text}, chr(10)), lambda x: list_transform(regexp_extract_all(x, '{PIECES}'), lambda y: md5(y)))"
    return f"""SELECT {keep}, {p}sketch, sha256(coalesce(array_to_string({p}sections, ','), '')) AS {p}root FROM (
  SELECT *, list_transform(list_filter(string_split(array_to_string(list_transform({p}sums, lambda h: h || CASE WHEN h[1] = '0' THEN '|' ELSE ',' END), ''), '|'), lambda s: s <> ''), lambda s: sha256(s)) AS {p}sections FROM (
  SELECT *, list_transform({p}lines, lambda l: sha256(coalesce(array_to_string(l, ','), ''))) AS {p}sums, list_sort(list_distinct(list_transform(flatten({p}lines), lambda h: h[1:{HEX}])))[1:{KEEP}] AS {p}sketch FROM (
  SELECT *, {lines} AS {p}lines FROM {source})))"""


def _like_sql(ra: str, a: str, rb: str, b: str) -> str:
    least = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{KEEP}]"
    return f"CASE WHEN {ra} = {rb} THEN 1.0::DOUBLE WHEN len({least}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({least}, list_intersect({a}, {b})))::DOUBLE / len({least}) END"


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
own AS ({_tree_sql('d', 'text', '', 'doc_id, text')}),
n AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(root) OVER w, first_value(root) OVER w) AS next_root,
  coalesce(lead(sketch) OVER w, first_value(sketch) OVER w) AS next_sketch FROM own WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, length(text) AS n_chars, root, sketch, next_root, next_sketch, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM n),
t AS ({_tree_sql('e', 'edited', 'edited_', 'doc_id, n_chars, root, sketch, next_root, next_sketch, edited')})
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, root || ':' || coalesce(array_to_string(sketch, ''), '') AS fingerprint,
  edited_root || ':' || coalesce(array_to_string(edited_sketch, ''), '') AS edited_fingerprint,
  {_like_sql('root', 'sketch', 'edited_root', 'edited_sketch')} AS near_edited, {_like_sql('root', 'sketch', 'next_root', 'next_sketch')} AS near_next FROM t
"""
