"""Operator 1, exact dedup by content-defined chunk recipes (DataFrame operations only).

Two texts are equal when identical after deleting all white space ([\x20\x09-\x0D]). The
normalised text is cut where its own content says so (a regular expression: a chunk
ends after ``least`` characters at the next pair from ``END`` and after ``most`` at the latest),
so equal passages give equal chunks wherever they stand. Then

1. each document becomes a recipe, the ordered list of its chunks' 64-bit fingerprints,
   which is written once without any text;
2. chunks are deduplicated on (fingerprint, content): map tasks send each distinct chunk
   once, so copies do not travel. A fingerprint with one content is a verified identifier;
3. a fingerprint that has several contents gets one identifier for each of them, and the
   recipes that hold it are rewritten by comparing content;
4. documents are equal when their ordered identifier lists are. Groups are one partial
   aggregate on the list, joined back; AQE splits that join where one group is large.

Of a group, the row with the most code points in its original text stays, ties to the
smallest doc_id (null last). Null text counts as empty; all empty texts are one group. Repeated
doc_ids are separate rows that get the same decision as equal rows (of fully identical rows all
are kept or dropped together). An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import WHITE, read_table, stored, text_of

LEAST, MOST = 512, 8192
#: A chunk may end after one of these: a vowel and one of seven consonants, or a mark that ends a clause in scripts other than Latin.
END = "[aeiouà-ö][bdfhkprw]|[。、，！？।،؟]"


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def chunks_of(norm: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(norm, F.lit(f"(?s).{{{least},{most}}}?(?:{END})|.{{1,{most}}}"), F.lit(0))


def fingerprint(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def verified_recipes(docs: DataFrame, recipes: DataFrame, fingerprint=fingerprint) -> DataFrame:
    """doc row key -> ordered list of verified identifiers (content, not fingerprint, decides)."""
    exploded = docs.select("row", F.posexplode(chunks_of(F.col("norm"))).alias("pos", "chunk"))
    chunks = exploded.select("row", "pos", "chunk", fingerprint(F.col("chunk")).alias("fp"))
    contents = chunks.select("fp", "chunk").distinct()
    counts = contents.groupBy("fp").agg(F.count("*").alias("contents"))
    shared = stored(counts.filter("contents > 1").select("fp"), "recipes-collided")
    if shared.isEmpty():
        return recipes.withColumn("ids", F.transform("fps", lambda f: F.struct(f.alias("fp"), F.lit(0).alias("variant"))))
    # Some fingerprints stand for several contents: number those, and rewrite the recipes by content.
    hit = chunks.join(shared, "fp")
    several = hit.select("fp", "chunk").distinct().groupBy("fp").agg(F.sort_array(F.collect_list("chunk")).alias("all"))
    fixed = hit.join(several, "fp").select("row", "pos", (F.array_position("all", F.col("chunk")) - 1).cast("int").alias("variant")).distinct()  # equal rows share a key
    per_row = fixed.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", "variant"))).alias("variants"))
    numbered = recipes.join(per_row, "row", "left").withColumn("variants", F.coalesce("variants", F.expr("map()").cast("map<int,int>")))
    return numbered.withColumn("ids", F.transform("fps", lambda f, i: F.struct(f.alias("fp"), F.coalesce(F.element_at("variants", i), F.lit(0)).alias("variant")))).drop("variants")


def exact_dedup(docs: DataFrame, fingerprint=fingerprint) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).alias("points"), normalised(text).alias("norm"))
    rows = rows.withColumn("sha", F.sha2("norm", 256))
    # A row's key for rewriting recipes: equal rows share it, as they share everything else.
    rows = rows.withColumn("row", F.struct("doc_id", "points", "sha"))
    recipe = rows.select("row", F.transform(chunks_of(F.col("norm")), fingerprint).alias("fps"))
    recipes = stored(recipe, "recipes")
    verified = verified_recipes(rows, recipes, fingerprint).select(F.col("row.*"), "ids")
    best = F.struct(F.col("points"), F.col("doc_id").isNotNull(), -F.coalesce("doc_id", F.lit(0)))
    groups = verified.groupBy("ids").agg(F.count("*").alias("group_size"), F.max(F.struct(best.alias("b"), "doc_id")).alias("m"))
    groups = groups.select(F.col("ids").alias("of"), "group_size", F.col("m.doc_id").alias("keep_id"), F.col("m.b").getField("points").alias("most"))
    groups = stored(groups, "recipe-groups")  # so that the join below has exchanges of its own, which can be split
    out = verified.join(groups, F.col("ids") == F.col("of"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return exact_dedup(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY norm) AS group_size, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id FROM d
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
