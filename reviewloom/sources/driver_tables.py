"""Review-shaped relations derived from the given tables.

Every line of every document is one review of run_a; about a quarter of the documents is delivered
again as run_b. A document is a file and its lines the file's rows. The source id is a hash of the
line's text, so boilerplate lines become in-run duplicates. Field defects follow from a hash of the
row's position, each in 1 or 2 % of the rows, so that every rule fires.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.functions import ids
from reviewloom.operators.lookups import first_per_key
from reviewloom.operators.tokens import UnknownWord
from reviewloom.sources.reviews_csv import polarities

WORDS = r"[\p{L}\p{N}]+"

# (text of the date field by one hash digit); {d} is a two-digit day and {h} a two-digit hour
POSTED_FORMS = {
    "0": "2024/2/{d} {h}:05", "1": "February {d}, 2024", "2": "2/{d}/2024 3:05 PM", "3": "2024-02-{d}T{h}",
    "4": "Sat, {d} Feb 2024 {h}:05:00 GMT", "5": "202402{d}{h}0500", "6": " Feb {d} 2024",
    "7": "2024-02-{d}T{h}:05:00+09:00", "8": "2024-02-{d} {h}:05:00+09", "9": "2024-02-{d}",
    "a": "2024-02-{d} {h}:05:30", "b": "2024-02-{d}T{h}:05:00Z", "c": "02/{d}/2024",
    "d": "202402{d}", "e": "2024-02-{d}T{h}:05:00.250-05:30", "f": "28/02/2024",
}
# What stands there in some 1.6 % of the rows instead, by the same digit
BAD_FORMS = {digit: ("", "abc", "15/2", " ")[i % 4] for i, digit in enumerate("0123456789abcdef")}

# (POS, sub-POS, inflection, lemma; empty = the term itself) by the first hash digit of a term
MORPH_CLASSES = {
    "0": ("名詞", "一般", "*", ""), "1": ("名詞", "サ変接続", "*", ""),
    "2": ("名詞", "固有名詞", "*", ""), "3": ("名詞", "非自立", "*", ""),
    "4": ("名詞", "一般", "*", "こと"), "5": ("動詞", "自立", "基本形", ""),
    "6": ("動詞", "自立", "連用形", ""), "7": ("動詞", "非自立", "連用形", ""),
    "8": ("形容詞", "自立", "基本形", ""), "9": ("形容詞", "自立", "連用テ接続", ""),
    "a": ("形容動詞", "形容動詞語幹", "*", ""), "b": ("助詞", "接続助詞", "*", "て"),
    "c": ("助詞", "連体化", "*", "の"), "d": ("助動詞", "*", "仮定形", "ば"),
    "e": ("助動詞", "*", "体言接続", "な"), "f": ("副詞", "一般", "*", ""),
}

# Morphemes that take part in compounds, by the first hash digit of a term
COMPOUND_CLASSES = {
    "0": ("名詞", "一般", "*", ""), "1": ("名詞", "サ変接続", "*", ""),
    "2": ("名詞", "サ変接続", "*", ""), "3": ("動詞", "自立", "未然形", ""),
    "4": ("動詞", "自立", "連用形", ""), "5": ("動詞", "自立", "連用タ接続", ""),
    "6": ("形容詞", "自立", "連用テ接続", ""), "7": ("動詞", "接尾", "未然形", "られる"),
    "8": ("助動詞", "*", "連用形", "ない"), "9": ("助動詞", "*", "基本形", "たい"),
    "a": ("動詞", "非自立", "連用形", "てる"), "b": ("助詞", "接続助詞", "*", "て"),
    "c": ("動詞", "自立", "連用形", "する"), "d": ("動詞", "自立", "基本形", "できる"),
    "e": ("助詞", "格助詞", "*", "を"), "f": ("動詞", "非自立", "連用形", "いる"),
}

# Words outside the dictionary stay in the text, without a role
UNKNOWN = UnknownWord("記号", "一般", "*")

ENTITIES = [
    "Room", "Bathroom", "Bedding", "Staff", "Breakfast", "Price",
    "Location", "Facilities", "Parking", "Lobby", "Network", "Booking",
]
ISSUES = [
    "Cleanliness", "Noise", "Odour", "Waiting", "Attitude",
    "Comfort", "Defect", "Safety", "Value", "Information",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer partitions than the cluster has cores.

    A few large row groups would leave most cores idle in the text-heavy steps that follow. Large
    inputs have far more splits than cores and are left as scanned.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _digit_value(digit: Column) -> Column:
    """1 for "0" up to 16 for "f"."""
    return F.instr(F.lit("0123456789abcdef"), digit)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw review relation; a narrow plan over one scan of ``documents``."""
    again = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "4"
    lines = (
        spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
        .select(
            "doc_id", "lang", "source",
            F.when(again, F.array(F.lit("run_a"), F.lit("run_b"))).otherwise(F.array(F.lit("run_a"))).alias("runs"),
            F.posexplode(F.split("text", "\n")).alias("line_pos", "line"),
        )
        .withColumn("h", F.md5(F.concat_ws("|", "doc_id", "line_pos")))
        .select("*", F.explode("runs").alias("run_id"))
    )
    h = F.col("h")
    day = F.lpad((_digit_value(F.substring(h, 6, 1)) + 5).cast("string"), 2, "0")
    hour = F.lpad((_digit_value(F.substring(h, 7, 1)) + 3).cast("string"), 2, "0")
    good, bad = (
        F.create_map(*[F.lit(x) for item in forms.items() for x in item]) for forms in (POSTED_FORMS, BAD_FORMS)
    )
    digit = F.substring(h, 5, 1)
    form = F.when(F.substring(h, 12, 2) < "04", bad[digit]).otherwise(good[digit])
    posted = F.replace(F.replace(form, F.lit("{d}"), day), F.lit("{h}"), hour)
    file = F.concat(F.lit("documents_"), "lang", F.lit(".csv"))
    path = F.concat(file, F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 20, "0"))
    number = (F.col("line_pos") + 1).cast("long")
    return lines.select(
        F.when(F.substring(h, 1, 2) < "02", "").otherwise(F.col("source")).alias("source"),
        F.when(F.substring(h, 1, 2).between("02", "04"), None)
        .otherwise(F.md5("line")).alias("source_id"),
        F.when(F.substring(h, 3, 2) < "02", None)
        .when(F.substring(h, 3, 2) < "04", "　 \t")
        .otherwise(F.col("line")).alias("review_text"),
        posted.alias("posted_at"),
        F.concat(F.lit("user_"), F.substring(h, 8, 4)).alias("user_name"),
        file.alias("source_file"),
        path.alias("source_path"),
        number.alias("row_number"),
        ids.row_id(F.col("run_id"), path, number).alias("row_id"),
        F.when(F.col("run_id") == "run_a", F.lit("2024-03-01 00:00:00"))
        .otherwise("2024-03-02 00:00:00").cast("timestamp").alias("ingested_at"),
        "run_id",
    ).select(*S.RAW_COLUMNS)


def dictionary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary candidates: every word of ``benchmark`` in reading order, terms repeating."""
    return (
        table(spark, sf_dir, "benchmark")
        .select("item_id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(WORDS), F.lit(0))).alias("pos", "term"))
        .withColumn("h", F.md5("term"))
    )


def pick(names: list[str], digit: Column) -> Column:
    """The name a hash digit stands for; NULL beyond the list."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), _digit_value(digit))


def sentiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.substring("h", 2, 1)
    polarity = (
        F.when(digit == "0", F.array(F.lit("negative")))
        .when(digit == "1", F.array(F.lit("positive")))
        .when(digit == "2", F.array(F.lit("negative"), F.lit("positive")))
    )
    return dictionary_rows(spark, sf_dir).select(
        "term", F.explode(polarity).alias("polarity"), F.lit("xx").alias("language")
    )


def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dictionary rows; the category of a repeated term varies, so the first row matters."""
    digit = F.substring(F.md5(F.concat_ws("|", "term", F.substring(F.md5(F.col("item_id").cast("string")), 1, 1))), 3, 1)
    return dictionary_rows(spark, sf_dir).select(
        "item_id", "pos", "term", F.lit("xx").alias("language"), pick(ENTITIES, digit).alias("entity"), F.lit(1).alias("version")
    ).where(F.col("entity").isNotNull())


def issue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.substring(F.md5(F.concat_ws("|", "term", F.substring(F.md5(F.col("item_id").cast("string")), 1, 1))), 4, 1)
    return dictionary_rows(spark, sf_dir).select(
        "item_id", "pos", "term", F.lit("xx").alias("language"), pick(ISSUES, digit).alias("issue_category"),
        F.lit("negative").alias("sentiment"), F.lit(1).alias("version"),
    ).where(F.col("issue_category").isNotNull())


def synonym_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synonym dictionary rows keyed by lemma and POS; the last row of a key matters."""
    morphs = morph_dictionary(spark, sf_dir).select(F.col("surface").alias("term"), "pos", "lemma")
    words = dictionary_rows(spark, sf_dir).where(F.substring("h", 5, 1) < "8").select(
        "item_id", F.col("pos").alias("place"), "term"
    )
    return words.join(morphs, "term").select(
        "item_id", "place", "lemma", "pos", F.concat_ws("_", F.lit("syn"), "item_id", "place").alias("synonym")
    )


def morph_dictionary(spark: SparkSession, sf_dir: str, classes: dict = MORPH_CLASSES) -> DataFrame:
    """POS dictionary: one row per dictionary word, classified by its hash."""
    entries = F.create_map(*[
        x for digit, (pos, sub, infl, lemma) in classes.items()
        for x in (F.lit(digit), F.struct(F.lit(pos).alias("pos"), F.lit(sub).alias("sub_pos"), F.lit(infl).alias("inflection"), F.lit(lemma).alias("lemma")))
    ])
    entry = F.col("entry")
    return (
        dictionary_rows(spark, sf_dir).select("term").distinct()
        .withColumn("entry", entries[F.substring(F.md5("term"), 1, 1)])
        .select(
            F.col("term").alias("surface"), entry["pos"].alias("pos"), entry["sub_pos"].alias("sub_pos"),
            entry["inflection"].alias("inflection"),
            F.when(entry["lemma"] == "", F.col("term")).otherwise(entry["lemma"]).alias("lemma"),
        )
    )


def lexicons(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dictionaries with one row per term."""
    return {
        "sentiment": polarities(sentiment_rows(spark, sf_dir)),
        "entity": first_per_key(entity_rows(spark, sf_dir), ["term"], "entity", ["item_id", "pos"]),
        "issue": first_per_key(issue_rows(spark, sf_dir), ["term"], "issue_category", ["item_id", "pos"]),
    }
