"""Retrieval: tokens, BM25 with boosted titles, a confidence floor, and answers that must cite what was found."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseloom.session import create_file, delete_path, read_file, stored

#: Fixed values.
STOP_WORDS = (
    "a an and are as at be by for from has have if in into is it its of on or "
    "should that the this to was were what when where which who will with"
).split()
TITLE_BOOST, K1, B, FLOOR = 3, 1.5, 0.75, 5.0
REFUSAL = "INSUFFICIENT_CONTEXT"
CITATION = r"\[(doc-[\w-]+)\]"

#: Query terms that are broadcast to the corpus; more are joined as Spark sees fit.
BROADCAST_TERMS = 100_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits without stop words; a plural s is dropped after that test."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: ~t.isin(*STOP_WORDS))
    plural = lambda t: (F.length(t) > 3) & F.endswith(t, F.lit("s")) & ~F.endswith(t, F.lit("ss"))
    return F.transform(words, lambda t: F.when(plural(t), F.substr(t, F.lit(1), F.length(t) - 1)).otherwise(t))


def doc_tokens(title: Column, text: Column) -> Column:
    """A document's tokens, its title's counted three times."""
    empty = F.array().cast("array<string>")
    return F.concat(F.flatten(F.array_repeat(F.coalesce(tokens(title), empty), TITLE_BOOST)), F.coalesce(tokens(text), empty))


def doc_frequency(corpus: DataFrame) -> DataFrame:
    """term, doc_freq: documents with the term."""
    each = corpus.select(F.explode(F.array_distinct(doc_tokens(F.col("title"), F.col("text")))).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("doc_freq"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term, qtf: how often a query has a term."""
    return queries.select("query_id", F.explode(tokens(F.col("question"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def _scored(postings: DataFrame, wanted: DataFrame, n: int, avg_len: float) -> DataFrame:
    """query_id, id, score > 0. postings: id, len, term, tf of the wanted terms. A query term counts as often as the query has it."""
    freq = postings.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.ln(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.lit(avg_len or 1.0)))
    weights = wanted.join(freq, "term")
    return postings.join(weights, "term").groupBy("query_id", "id").agg(F.sum(part * F.col("qtf")).alias("score")).where("score > 0")


def _of_terms(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted terms; few terms travel to the rows, so that no other row is moved."""
    terms = wanted.select("term").distinct()
    return rows.join(F.broadcast(terms) if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else terms, "term", "left_semi")


def bm25_scores(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, id, score > 0. corpus: id, title, text; queries: query_id, question.

    One pass over the corpus takes its size, the lengths and the counts of the queries' terms; other terms
    never leave the scan. For many batches of queries build a :class:`Bm25Index` once.
    """
    wanted = stored(query_terms(queries), "query-terms")
    if corpus.isEmpty() or wanted.isEmpty():  # what is empty is not run, and then observes nothing
        return corpus.select(F.lit("").alias("query_id"), "id", F.lit(0.0).alias("score")).limit(0)
    size = Observation()
    sized = corpus.select("id", doc_tokens(F.col("title"), F.col("text")).alias("toks")).select("id", F.size("toks").alias("len"), "toks")
    sized = sized.observe(size, F.count("*").alias("n"), F.sum("len").alias("total"))
    hits = _of_terms(sized.select("id", "len", F.explode_outer("toks").alias("term")), wanted)
    postings = stored(hits.groupBy("id", "len", "term").agg(F.count("*").alias("tf")), "postings")
    return _scored(postings, wanted, size.get["n"], size.get["total"] / size.get["n"])


class Bm25Index:
    """Postings below a path, clustered and sorted by term, with the corpus' size: built once, searched in batches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        facts = json.loads(read_file(spark, f"{self.path}/_corpus.json"))
        self.n, self.avg_len = facts["n"], facts["avg_len"]

    @classmethod
    def build(cls, corpus: DataFrame, path: str) -> Bm25Index:
        """Replaces what is at the path. The size is written last, so a broken build is no index."""
        spark, where = corpus.sparkSession, path.rstrip("/")
        delete_path(spark, where)
        corpus.write.parquet(f"{where}/documents")
        kept = spark.read.parquet(f"{where}/documents")
        sized = kept.select("id", doc_tokens(F.col("title"), F.col("text")).alias("toks")).select("id", F.size("toks").alias("len"), "toks")
        # Every document has a row, with a NULL term where it has no token, so the sizes can be read back.
        counted = sized.select("id", "len", F.explode_outer("toks").alias("term")).groupBy("id", "len", "term").agg(F.count("*").alias("tf"))
        # By ranges of terms: a term of very many documents is split over tasks, and row groups tell their terms.
        counted.repartitionByRange(F.col("term"), F.xxhash64("id")).sortWithinPartitions("term").write.parquet(f"{where}/postings")
        total = spark.read.parquet(f"{where}/postings").where("term is not null").agg(F.sum("tf").alias("total")).first().total or 0
        n = kept.count()
        create_file(spark, f"{where}/_corpus.json", json.dumps({"n": n, "avg_len": total / n if n else 1.0}))
        return cls(spark, where)

    def corpus(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/documents")

    def scores(self, queries: DataFrame) -> DataFrame:
        """As :func:`bm25_scores`, without reading the corpus."""
        wanted = stored(query_terms(queries), "query-terms")
        return _scored(_of_terms(self.spark.read.parquet(f"{self.path}/postings"), wanted), wanted, self.n, self.avg_len)

    def search(self, queries: DataFrame, k: int = 3) -> DataFrame:
        return top_k(self.scores(queries), k)


def top_k(scores: DataFrame, k: int = 3) -> DataFrame:
    """The k best documents of each query with their rank. Scores equal to nine decimals are ties and go by id."""
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def confidence(queries: DataFrame, hits: DataFrame, floor: float = FLOOR) -> DataFrame:
    """query_id, best, refused: without a hit of at least the floor a question is refused before any model is asked."""
    best = hits.where("rank = 1").select("query_id", F.col("score").alias("best"))
    return queries.select("query_id").join(best, "query_id", "left").select("query_id", "best", F.coalesce(F.col("best") < floor, F.lit(True)).alias("refused"))


def remote_hits(queries: DataFrame, search: Callable[[str, int], list[tuple[str, float]]], k: int = 3) -> DataFrame:
    """query_id, id, score, rank from a hosted search service: ``search(question, k)`` gives (id, score) pairs.

    The counterpart of :func:`top_k` of :func:`bm25_scores` for a remote index; questions go out in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (q, i, float(s), n)
                for q, t in zip(b.column("query_id").to_pylist(), b.column("question").to_pylist())
                for n, (i, s) in enumerate(sorted(search(t or "", k), key=lambda h: (-h[1], h[0]))[:k], 1)
            ]
            names = ("query_id", "id", "score", "rank")
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in range(4)], names=list(names))

    return queries.select(F.col("query_id").cast("string").alias("query_id"), "question").mapInArrow(run, "query_id string, id string, score double, rank int")


def passage_answer(doc_id: Column, text: Column) -> Column:
    """The offline answer: the first sentence of the best passage and its citation."""
    return F.concat(F.trim(F.element_at(F.split(text, r"\. "), 1)), F.lit(". ["), doc_id, F.lit("]"))


def enforce_citations(answers: DataFrame) -> DataFrame:
    """answers: query_id, reply, retrieved (ids). Adds citations and grounded; a reply citing nothing that was
    retrieved becomes a refusal."""
    cited = F.regexp_extract_all(F.col("reply"), F.lit(CITATION), F.lit(1))
    valid = F.filter(cited, lambda c: F.array_contains("retrieved", c))
    kept = answers.withColumn("citations", valid)
    refused = (F.trim("reply") == REFUSAL) | (F.size("citations") == 0)
    return kept.select(
        "query_id",
        F.when(refused, REFUSAL).otherwise(F.trim("reply")).alias("answer"),
        F.when(refused, F.array().cast("array<string>")).otherwise(F.col("citations")).alias("citations"),
        F.array_sort("retrieved").alias("retrieved"),
        (~refused).alias("grounded"),
        F.when(F.trim("reply") != REFUSAL, F.when(F.size("citations") == 0, "no valid citation; downgraded")).alias("note"),
    )


def answer_questions(corpus: DataFrame, queries: DataFrame, k: int = 3, floor: float = FLOOR, hits: DataFrame | None = None) -> DataFrame:
    """Grounded answers with the offline backend for a batch of questions. ``hits``: of an index or a remote search, else found here."""
    hits = top_k(bm25_scores(corpus, queries), k) if hits is None else hits
    sure = confidence(queries, hits, floor)
    found = hits.groupBy("query_id").agg(F.collect_set("id").alias("retrieved"), F.min_by("id", "rank").alias("first_id"))  # k each
    texts = corpus.select(F.col("id").alias("first_id"), "text")
    replies = (
        sure.join(found, "query_id", "left")
        .join(texts, "first_id", "left")
        .select("query_id", F.coalesce("retrieved", F.array().cast("array<string>")).alias("retrieved"),
                F.when(F.col("refused"), REFUSAL).otherwise(passage_answer(F.col("first_id"), F.col("text"))).alias("reply"), "refused")
    )
    return enforce_citations(replies)
