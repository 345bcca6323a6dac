"""Documents to training rows: a chain of operators of ``tractscope.llm``.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of
``documents``. Every stage works on all rows that its predecessor kept.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractscope.llm import jaccard_join, language_id, piece_encode, quality_rules, source_mix
from tractscope.llm.tables import join_small
from tractscope.session import write_once

MIX_SEED = 7


def renamed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` under column names that clash with none of an operator's."""
    inner = [f"doc_column_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*inner), inner


# A recorded language gives way to a prediction that is at least so sure.
SURE = 0.95


def known_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: frozenset | None = None
) -> DataFrame:
    """Documents in a wanted language, with the language that their text says they are in.

    The network is learnt from the documents that are not held out, and wanted are all the
    languages it learns if none are named. Rejected are texts without a letter, and texts
    whose likeliest language is not wanted. ``lang`` is filled where it is null; where it
    names another of the learnt languages it is corrected if the prediction is ``SURE``. No
    least score is asked for: a clean text in one of several close languages may score little
    more than one divided by their number. If no document can be learnt from, nothing is
    known of any, and all pass as they are.
    """
    net = language_id.train(docs)
    if net is None:
        return docs
    plain, inner = renamed(docs)
    of = dict(zip(docs.columns, inner, strict=True))
    found = language_id.identify(plain, net, of["text"], tuple(inner))
    languages = net.languages if wanted is None else sorted(wanted)
    recorded, said = F.col(of["lang"]), F.col("lang_pred")
    sure = (F.col("score") >= SURE) & recorded.isin(net.languages)
    lang = F.when(recorded.isNull() | sure, said).otherwise(recorded)
    kept = found.where((said != language_id.UNKNOWN) & said.isin(languages))
    return kept.withColumn(of["lang"], lang).select(*inner).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Rows are told apart by a number as well, so that of rows that share an id, or have none,
    one stays. They are written once with these numbers. The numbers of the rows that go are
    broadcast if they are few, else joined by a shuffle.
    """
    plain, inner = renamed(docs)
    numbered = write_once(
        plain.withColumn("row", F.monotonically_increasing_id()), "near-documents"
    )
    of = dict(zip(docs.columns, inner, strict=True))
    doc_id = F.col(of["doc_id"])
    key = F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), "row")
    found = jaccard_join.link_components(
        numbered.select(key.alias("key"), F.col(of["text"]).alias("text")), "key"
    )
    gone = found.where(F.col("key") != F.col("component_id")).select("key.row")
    kept = join_small(numbered, write_once(gone, "near-duplicates"), "row", "left_anti")
    return kept.select(*inner).toDF(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, as repeated rows.

    The rows are numbered, counted and written once. What the mix decides are small tables,
    so the texts are not shuffled.
    """
    plain, inner = renamed(docs)
    of = dict(zip(docs.columns, inner, strict=True))
    numbered = plain.withColumns(
        {
            "id": F.col(of["doc_id"]),
            "source": F.col(of["source"]),
            "size": source_mix.word_count(F.col(of["text"])),
            "row": F.monotonically_increasing_id(),
        }
    )
    numbered = write_once(numbered, "mix-documents")
    plan = source_mix.plan_mix(numbered.select("id", "source", "size", "row"), MIX_SEED)
    mixed = source_mix.apply_mix(numbered, plan)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("repeats").cast("int")))
    return mixed.select(*inner, copies.alias("copy")).drop("copy").toDF(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text for every row."""
    return piece_encode.round_trip(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language", known_language),
    ("rules", good_quality),
    ("near duplicates", one_of_each_group),
    ("mix", mixed_sources),
    ("pieces", pieces),
]
# The language network cannot be put as SQL; tests/llm checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
