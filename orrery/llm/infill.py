"""Fill-in-middle: cut a text at two token bounds and move its middle to the end.

``regexp_count`` gives the n tokens of a text. A pattern of its own for every row, ``(unit{a})(unit{b-a})(rest)``
with possessive counts, then captures prefix, middle and suffix in one match, whose replacement puts a mark between
them. Possessive counts are loops in the regex engine: no recursion and no way back, so a match is linear in
the text and needs no stack, however long the text is. All of it is column expressions; rows never meet.

``h1`` to ``h4`` are four 32-bit numbers of sha256("<seed>:<doc_id>"). Bounds are ``h1 % (n + 1)`` and ``h2 % (n + 1)``;
``h3`` decides whether a text is cut, ``h4`` in which order. A text that holds a mark stays plain, so the first
marks of an output that is not plain are always its own and ``restore`` is exact.

Cases: a null text is an empty one and stays plain; white space alone is one token; a null doc_id is hashed as empty
text, so such rows share one draw; rows of equal doc_id are cut alike; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import texts

SPACE = r"\x20\x09-\x0D"
#: A token: white space and the word after it, or the white space at the end.
UNIT = rf"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"
#: Of 100 texts so many are cut; of 100 cut ones so many put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SEED = 42


def draws(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def infill(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, text, n, form (plain, psm, spm), prefix, middle, suffix (null where plain) and output of every text."""
    h = [F.col(f"h{i}") for i in range(1, 5)]
    rows = texts(docs).withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    rows = rows.withColumns({f"h{i}": d for i, d in enumerate(draws(F.col("doc_id"), seed), 1)})
    plain = (F.col("n") == 0) | F.col("text").rlike(MARK) | (h[2] % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm"))
    one, two = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    a, b = F.least(one, two), F.greatest(one, two)
    pattern = F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*+)", a, b - a)
    marked = F.regexp_replace(F.col("text"), pattern, F.lit(f"$1{SUFFIX}$2{SUFFIX}$3"))
    rows = rows.withColumn("part", F.when(F.col("form") != "plain", F.split(marked, SUFFIX, -1)))
    rows = rows.select("doc_id", "text", "n", "form", *[F.col("part")[i].alias(name) for i, name in enumerate(("prefix", "middle", "suffix"))])
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    return rows.withColumn("output", F.when(F.col("form") == "spm", spm).when(F.col("form") == "psm", psm).otherwise(F.col("text")))


def restore(output: Column, form: Column) -> Column:
    """The text that ``infill`` was given, from its output and form alone."""
    part = F.split(output, MARK, -1)  # '', first, second, middle
    return F.when(form == "spm", F.concat(part[2], part[3], part[1])).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return infill(docs).select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


ORACLE_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || doc_id) AS d FROM documents),
u AS (SELECT doc_id, text, d, regexp_extract_all(text, '[{SPACE}]*[^{SPACE}]+|[{SPACE}]+') AS unit FROM t),
h AS (SELECT doc_id, text, unit, len(unit)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
  ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
  WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(unit[1:a], '') AS x, array_to_string(unit[a + 1:b], '') AS y, array_to_string(unit[b + 1:], '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
