"""Keyword retrieval over document chunks: chunking, terms, BM25, and text guards."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import INJECTIONS, MAIL_PATTERN, PHONE_PATTERN, STOP_WORDS

K1, B = 1.5, 0.75
#: Chunks and queries of one cell of a search with many queries.
CELL_CHUNKS, CELL_QUERIES = 8_192, 4_096


def injection(text: Column) -> Column:
    """True where a text tries to replace its reader's instructions; False for NULL."""
    hits = F.lit(False)
    for pattern in INJECTIONS:
        hits = hits | text.rlike(pattern)
    return F.coalesce(hits, F.lit(False))


def redact_mail(text: Column) -> Column:
    return F.regexp_replace(text, MAIL_PATTERN, "[REDACTED_EMAIL]")


def redact(text: Column) -> Column:
    """Mail addresses first, then phone-like numbers."""
    return F.regexp_replace(redact_mail(text), PHONE_PATTERN, "[REDACTED_PHONE]")


def terms(text: Column) -> Column:
    """Lower-case words of letters and digits without stop words; repeats stay. Empty array for NULL."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    stop = F.array(*[F.lit(w) for w in sorted(STOP_WORDS)])
    return F.filter(words, lambda w: ~F.array_contains(stop, w))


def chunks(documents: DataFrame, doc_id: str, text: str, title: str | None = None, version: str | None = None, max_words: int = 120, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, section, ordinal, chunk_id, chunk, content_hash, [title], keep...) of Markdown-like texts.

    Headings begin sections, text before the first is in "Overview"; each section is cut into windows
    of ``max_words`` words. Blank and instruction-like chunks are left out. One pass per document,
    no shuffle.
    """
    if max_words < 20:
        raise ValueError("max_words must be at least 20")
    keep = keep or []
    marked = F.regexp_replace(F.col(text), r"(?m)^#{1,6}[ \t]+(.+?)[ \t]*\r?$", "\u0001$1\u0002")
    parts = F.split(F.concat(F.lit("Overview\u0002"), marked), "\u0001")
    sections = documents.select(doc_id, *([title] if title else []), *([version] if version else []), *keep, F.posexplode(parts).alias("section_no", "part"))
    head = F.trim(F.substring_index("part", "\u0002", 1))
    body = F.trim(F.regexp_replace(F.expr("substring(part, instr(part, '\u0002') + 1)"), r"\s+", " "))
    sections = sections.withColumns({"section": head, "words": F.when(body != "", F.split(body, " "))}).where("words IS NOT NULL")
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(max_words))
    cut = sections.select("*", F.posexplode(F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, F.lit(max_words)), " "))).alias("ordinal", "chunk"))
    cut = cut.where(~injection(F.col("chunk"))).withColumn("content_hash", F.sha2("chunk", 256))
    id_ = F.substring(F.sha2(F.concat_ws("|", F.col(doc_id).cast("string"), F.col(version).cast("string") if version else F.lit("1"), F.col("section"), F.col("ordinal").cast("string"), F.col("content_hash")), 256), 1, 20)
    return cut.select(doc_id, *([title] if title else []), *keep, "section", "section_no", "ordinal", id_.alias("chunk_id"), "chunk", "content_hash")


def frequencies(postings: DataFrame) -> DataFrame:
    """(term, df): chunks that hold each term."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))


def index(chunked: DataFrame, chunk_id: str, text: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings (chunk_id, term, tf, dl), document frequencies (term, df), statistics (n, avgdl) of all chunks."""
    termed = chunked.select(F.col(chunk_id).alias("chunk_id"), terms(text).alias("terms"))
    postings = termed.select("chunk_id", F.size("terms").cast("double").alias("dl"), F.explode("terms").alias("term")).groupBy("chunk_id", "term").agg(F.count(F.lit(1)).cast("double").alias("tf"), F.max("dl").alias("dl"))
    df = frequencies(postings)
    stats = termed.agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg(F.size("terms").cast("double")).alias("avgdl"))
    return postings, df, stats


_EDGE, _END = "(?<![a-z0-9])", "(?![a-z0-9])"


def _uses(low: Column, words: list[str]) -> Column:
    """How often any of the words stands in lower-case text; one pass of one pattern."""
    return F.regexp_count(low, F.lit(f"{_EDGE}(?:{'|'.join(words)}){_END}")).cast("double")


def _asked(spark, query: str) -> list[str]:
    return sorted(set(spark.range(1).select(terms(F.lit(query)).alias("t")).first()["t"]))


def _idf(n: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def _score(wanted: list[str], df: list[float], n: float, avgdl: float) -> tuple[Column, Column]:
    """BM25 and number of matched terms over columns dl, tf0, tf1, ..."""
    score, matched = F.lit(0.0), F.lit(0)
    for i in range(len(wanted)):
        tf = F.col(f"tf{i}")
        idf = _idf(F.lit(n), F.lit(df[i]))
        norm = tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * F.col("dl") / F.lit(avgdl))
        score = score + F.when(tf > 0, idf * tf * F.lit(K1 + 1.0) / norm).otherwise(F.lit(0.0))
        matched = matched + (tf > 0).cast("int")
    return F.round(score, 6), matched


def _best(hits: DataFrame, wanted: list[str], score: Column, matched: Column, top_k: int, minimum: float) -> DataFrame:
    found = hits.where(matched >= min(2, len(wanted))).where("ok").select("chunk_id", score.alias("score"))
    return found.where(F.col("score") >= minimum).orderBy(F.col("score").desc(), "chunk_id").limit(top_k)


def search(chunked: DataFrame, chunk_id: str, text: Column, query: str, top_k: int = 10, minimum: float = 0.0, allowed: Column | None = None) -> DataFrame:
    """(chunk_id, score): the best ``top_k`` by BM25, ties by id.

    At least two of the query's distinct terms must match, or its only one. Statistics cover all
    chunks, also those that ``allowed`` hides from the result. Terms are counted in the text where
    it lies, so nothing but the statistics and the best rows of each task moves. A query without
    terms finds nothing.
    """
    wanted = _asked(chunked.sparkSession, query)
    if not wanted:
        return chunked.select(F.col(chunk_id).alias("chunk_id"), F.lit(0.0).alias("score")).limit(0)
    low = chunked.select(F.col(chunk_id).alias("chunk_id"), (allowed if allowed is not None else F.lit(True)).alias("ok"), F.lower(F.coalesce(text, F.lit(""))).alias("low"))
    t = F.col("low")
    size = F.regexp_count(t, F.lit("[a-z0-9]+")).cast("double") - _uses(t, sorted(STOP_WORDS))
    hits = low.select("chunk_id", "ok", size.alias("dl"), *[_uses(t, [w]).alias(f"tf{i}") for i, w in enumerate(wanted)])
    sums = hits.agg(F.count(F.lit(1)).cast("double").alias("n"), F.greatest(F.avg("dl"), F.lit(1.0)).alias("avgdl"), *[F.sum((F.col(f"tf{i}") > 0).cast("double")).alias(f"df{i}") for i in range(len(wanted))]).first()
    score, matched = _score(wanted, [sums[f"df{i}"] or 0.0 for i in range(len(wanted))], sums["n"], sums["avgdl"] or 1.0)
    return _best(hits, wanted, score, matched, top_k, minimum)


def save_index(store, name: str, chunked: DataFrame, chunk_id: str, text: Column) -> None:
    """Writes postings (sorted by term, so a search reads only its terms' row groups), frequencies and statistics."""
    postings, df, stats = index(chunked, chunk_id, text)
    store.write(f"{name}_postings", postings.repartitionByRange("term").sortWithinPartitions("term"))
    store.write(f"{name}_terms", df)
    store.write(f"{name}_stats", stats)


def search_index(store, name: str, query: str, top_k: int = 10, minimum: float = 0.0) -> DataFrame:
    """As :func:`search`, from a saved index; chunks without any term of the query are never read."""
    spark = store.spark
    wanted = _asked(spark, query)
    if not wanted:
        return spark.createDataFrame([], "chunk_id string, score double")
    stats = store.read(f"{name}_stats").first()
    df = {r.term: r.df for r in store.read(f"{name}_terms").where(F.col("term").isin(wanted)).collect()}  # one row per term of the query
    rows = store.read(f"{name}_postings").where(F.col("term").isin(wanted))
    hits = rows.groupBy("chunk_id").agg(F.lit(True).alias("ok"), F.max("dl").alias("dl"), *[F.coalesce(F.max(F.when(F.col("term") == w, F.col("tf"))), F.lit(0.0)).alias(f"tf{i}") for i, w in enumerate(wanted)])
    score, matched = _score(wanted, [df.get(w, 0.0) for w in wanted], stats["n"], max(stats["avgdl"] or 1.0, 1.0))
    return _best(hits, wanted, score, matched, top_k, minimum)


def _cell(avgdl: float, top_k: int, minimum: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best ``top_k`` chunks of one cell for each of its queries; postings are added up in order of term."""

    def best(postings: pa.Table, asked: pa.Table) -> pa.Table:
        asked = asked.sort_by([("query_id", "ascending"), ("word", "ascending")])
        ids = pc.unique(postings["chunk_id"])
        ids = ids.take(pc.sort_indices(ids))  # so a chunk's number is its rank among ties
        words = pc.unique(postings["term"])
        word = pc.index_in(postings["term"], value_set=words).to_numpy()
        order = np.argsort(word, kind="stable")
        word, chunk = word[order], pc.index_in(postings["chunk_id"], value_set=ids).to_numpy()[order]
        start = np.searchsorted(word, np.arange(len(words) + 1))
        wanted = pc.fill_null(pc.index_in(asked["word"], value_set=words), -1).to_numpy()
        idf = np.zeros(len(words))
        idf[wanted[wanted >= 0]] = asked["idf"].to_numpy()[wanted >= 0]
        tf, dl = postings["tf"].to_numpy()[order], postings["dl"].to_numpy()[order]
        part = idf[word] * tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * dl / avgdl))
        query = pc.index_in(asked["query_id"], value_set=pc.unique(asked["query_id"])).to_numpy()
        cuts = [*np.flatnonzero(np.diff(query, prepend=-1)), len(query)]
        rows, chunks, scores = [np.empty(0, "int64")], [np.empty(0, "int64")], [np.empty(0)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            lists = [slice(start[w], start[w + 1]) for w in wanted[a:b] if w >= 0]
            if not lists:
                continue
            hit = np.concatenate([chunk[x] for x in lists])
            matched = np.bincount(hit, minlength=len(ids))
            score = np.round(np.bincount(hit, np.concatenate([part[x] for x in lists]), len(ids)), 6)
            found = np.flatnonzero((matched >= min(2, b - a)) & (score >= minimum))
            if len(found) > top_k:
                least = np.partition(score[found], len(found) - top_k)[len(found) - top_k]
                found = found[score[found] >= least]
            found = found[np.lexsort((found, -score[found]))][:top_k]
            rows.append(np.full(len(found), a))
            chunks.append(found)
            scores.append(score[found])
        return pa.table({"query_id": asked["query_id"].take(pa.array(np.concatenate(rows))), "chunk_id": ids.take(pa.array(np.concatenate(chunks))), "score": np.concatenate(scores)})

    return best


def search_all(postings: DataFrame, df: DataFrame, stats: DataFrame, asked: DataFrame, top_k: int = 10, minimum: float = 0.0, cell: tuple[int, int] = (CELL_CHUNKS, CELL_QUERIES)) -> DataFrame:
    """(query_id, chunk_id, score): for each query what :func:`search` finds for it.

    ``postings``, ``df`` and ``stats`` are an index, ``asked`` the distinct (query_id, term) of the
    queries. Chunks and queries are dealt by hash into cells of bounded size, so the postings of a
    frequent term lie in many cells and the pairs of queries and chunks are added up where they
    arise; only the best of each cell move on. Work grows with queries times chunks.
    """
    n, avgdl = stats.first()  # one row
    many = asked.agg(F.count_distinct("query_id")).first()[0]
    across, down = (max(1, -(-int(x) // size)) for x, size in zip((n, many), cell))
    deal = lambda c, blocks: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    weighed = asked.join(df, "term", "left").select("query_id", F.col("term").alias("word"), _idf(F.lit(n), F.coalesce("df", F.lit(0.0))).alias("idf"))
    left = postings.where("chunk_id IS NOT NULL").select(deal("chunk_id", across).alias("x"), every(down).alias("y"), "chunk_id", "term", "tf", "dl")
    right = weighed.where("query_id IS NOT NULL").select(every(across).alias("x"), deal("query_id", down).alias("y"), "query_id", "word", "idf")
    kinds = f"query_id {asked.schema['query_id'].dataType.simpleString()}, chunk_id {postings.schema['chunk_id'].dataType.simpleString()}, score double"
    found = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(_cell(max(avgdl or 1.0, 1.0), top_k, minimum), kinds)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "chunk_id"))
    return found.withColumn("place", place).where(F.col("place") <= top_k).drop("place")
