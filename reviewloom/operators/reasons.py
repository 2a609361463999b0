"""From extracted pairs to rows of the reasons table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.functions import ids

# What a missing part costs, and what each token of distance costs.
NO_ENTITY = 0.2
NO_ISSUE = 0.2
INCOMPLETE = 0.3
PER_TOKEN = 0.03


def split_predicates(pairs: DataFrame) -> DataFrame:
    """One row per polarity and predicate; a term without predicates keeps one row."""
    return pairs.select(
        "run_id", "review_id", "row_id", "subjects",
        F.explode("polarities").alias("sentiment_type"), "predicates",
    ).select("*", F.explode_outer("predicates").alias("predicate")).drop("predicates")


def by_review(pairs: DataFrame) -> DataFrame:
    """Pairs of a row per term as one row per review, as :func:`extract.review_pairs` gives them."""
    if "pairs" in pairs.columns:
        return pairs
    pair = F.struct("term_index", "polarities", "subjects", "predicates")
    return pairs.groupBy("run_id", "review_id", "row_id").agg(F.collect_list(pair).alias("pairs"))


def distinct_reasons(pairs: DataFrame) -> DataFrame:
    """One row per reason of a review: its terms' pairs split by polarity and predicate, where those
    with the same subject and predicate positions and sentiment are one.

    Duplicates stand in one review, so they are removed on its row: in the order of their key, all but
    the first of equal ones go. Nothing is shuffled if ``pairs`` has a row per review. The sort stands
    in a column of its own, so that its comparison is compiled, and most end at the first number.
    """
    def of_term(pair: Column) -> Column:
        predicates = F.when(F.size(pair["predicates"]) > 0, pair["predicates"]).otherwise(
            F.array(F.try_element_at(pair["predicates"], F.lit(1))))
        return F.flatten(F.transform(pair["polarities"], lambda label: F.transform(predicates, lambda predicate: F.struct(
            predicate["index"].alias("predicate_index"), label.alias("sentiment_type"),
            F.transform(pair["subjects"], lambda s: s["index"]).alias("subject_indices"),
            pair["subjects"].alias("subjects"), predicate.alias("predicate"),
        ))))

    def is_new(x: Column, before: Column) -> Column:
        same = F.lit(True)
        for name in ("predicate_index", "sentiment_type", "subject_indices"):
            same = same & x[name].eqNullSafe(before[name])
        return ~same

    # all of a review's reasons, sorted by their key, which comes first
    reasons = F.sort_array(F.flatten(F.transform("pairs", of_term)))
    found = by_review(pairs).select("run_id", "review_id", "row_id", reasons.alias("found"))
    distinct = F.filter("found", lambda x, i: (i == 0) | is_new(x, F.get("found", i - 1)))
    rows = found.select("run_id", "review_id", "row_id", F.explode_outer(distinct).alias("reason"))
    return rows.where("reason IS NOT NULL").select("run_id", "review_id", "row_id", "reason.*")


def first_entity(subjects: Column) -> Column:
    """Entity of the first subject that has one."""
    return F.try_element_at(F.filter(subjects, lambda s: s["entity"].isNotNull()), F.lit(1))["entity"]


def nearest_distance(subject_indices: Column, predicate_index: Column) -> Column:
    return F.array_min(F.transform(subject_indices, lambda i: F.abs(i - predicate_index)))


def confidence(entity: Column, issue: Column, subject_indices: Column, predicate_index: Column) -> Column:
    """1 less the cost of missing parts and distance; never below 0; two decimals."""
    complete = (F.size(subject_indices) > 0) & predicate_index.isNotNull()
    distance = nearest_distance(subject_indices, predicate_index)
    score = (
        F.lit(1.0)
        - F.when(entity.isNull(), NO_ENTITY).otherwise(0.0)
        - F.when(issue.isNull(), NO_ISSUE).otherwise(0.0)
        - F.when(complete, PER_TOKEN * (distance - 1)).otherwise(INCOMPLETE)
    )
    return F.round(F.greatest(score, F.lit(0.0)), 2)


def reason_id(random: bool = False, namespace: str = ids.DEFAULT_NAMESPACE) -> Column:
    """A stable id from what identifies a reason; random on request."""
    if random:
        return F.uuid()
    name = F.concat_ws(
        "|", "run_id", "row_id", F.array_join(F.col("subject_indices").cast("array<string>"), ","),
        F.coalesce(F.col("predicate_index").cast("string"), F.lit("")), "sentiment_type",
    )
    return ids.uuid5(name, namespace)


def finish_reasons(distinct: DataFrame, random_ids: bool = False) -> DataFrame:
    """Category, confidence, id and words of each distinct reason."""
    return (
        distinct.withColumns({
            "entity": first_entity(F.col("subjects")),
            "issue_category": F.col("predicate.issue_category"),
        })
        .withColumns({
            "confidence": confidence(
                F.col("entity"), F.col("issue_category"), F.col("subject_indices"), F.col("predicate_index")),
            "reason_id": reason_id(random_ids),
            "subject": F.col("subjects")["lemma"],
            "predicate": F.col("predicate.lemma"),
        })
    )


def build_reasons(pairs: DataFrame, random_ids: bool = False) -> DataFrame:
    """Extracted pairs of all reviews, a row per review or per term, to reasons."""
    return finish_reasons(distinct_reasons(pairs), random_ids).select(*S.REASON_COLUMNS)
