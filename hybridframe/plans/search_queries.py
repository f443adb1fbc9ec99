"""Vector search, full-text search and hybrid search."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridframe import results
from hybridframe.functions.vectors import similarity
from hybridframe.operators import approximate, blocks, deltas, fulltext, hashing, quantised, tiles
from hybridframe.operators.embed import HashingEmbedder, embed
from hybridframe.operators.hybrid import hybrid_search
from hybridframe.operators.nearest import nearest, nearest_batch, query_shape
from hybridframe.operators.retrieve import select_records
from hybridframe.plans.registry import RECORDS, VECTORS, has_any, query, terms_of
from hybridframe.plans.session import shared_folder, written
from hybridframe.plans.standard import records, table, vector_records

K = 10


def vector_of(spark, sf, number: int) -> list[float]:
    return [float(x) for x in table(spark, sf, "embeddings").filter(F.col("vec_id") == number).first()["embedding"]]


def vector_queries(spark, sf):
    """Every vector as a query."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))


def text_queries(spark, sf):
    """Every benchmark passage as a query."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _whole(name: str):
    """A rank as SQL numbers rows."""
    return F.col(name).cast("long").alias(name)


def _listed(hits, *more):
    return hits.select(_whole("rank"), "_id", "distance", *more)


# --- exact nearest neighbours ---

MEASURE = {
    "l2": ("round(list_distance(x.embedding, q.embedding), 9)", "ASC"),
    "cosine": ("round(greatest(list_cosine_distance(x.embedding, q.embedding), 0.0), 9)", "ASC"),
    "inner_product": ("round(list_inner_product(x.embedding, q.embedding), 9)", "DESC"),
}


def nearest_sql(metric: str, source: str = "v", where: str = "TRUE", extra: str = "", k: int = K, number: int = 7) -> str:
    measure, order = MEASURE[metric]
    return f"""WITH {RECORDS}, {VECTORS}, m AS (
      SELECT x.*, {measure} AS d FROM {source} x, v q WHERE q._id = '{number}' AND x.embedding IS NOT NULL AND ({where}))
    SELECT row_number() OVER (ORDER BY d {order}, _id) AS rank, _id, d AS distance{extra} FROM m ORDER BY d {order}, _id LIMIT {k}"""


for _metric, _name in (("l2", "knn_l2"), ("cosine", "knn_cosine"), ("inner_product", "knn_ip")):

    def _one(spark, sf, metric=_metric):
        return _listed(nearest(vector_records(spark, sf), vector_of(spark, sf, 7), K, metric, include=()))

    query(_name, nearest_sql(_metric))(_one)


@query("knn_filtered", nearest_sql("cosine", "r", "x.lang = 'en' AND x.n_chars > 500", ", document, metadata"))
def knn_filtered(spark, sf):
    where = {"lang": "en", "n_chars": {"$gt": 500}}
    return _listed(nearest(records(spark, sf), vector_of(spark, sf, 7), K, "cosine", where), "document", "metadata")


@query("knn_doc_filtered", nearest_sql("l2", "r", has_any("x.document", "nicht", "que")))
def knn_doc_filtered(spark, sf):
    return _listed(nearest(records(spark, sf), vector_of(spark, sf, 7), K, "l2", None, {"$contains": "nicht que"}, ()))


@query("knn_similarity", nearest_sql("l2").replace("AS distance", "AS distance, 1.0 / (1.0 + d) AS similarity"))
def knn_similarity(spark, sf):
    hits = nearest(vector_records(spark, sf), vector_of(spark, sf, 7), K, "l2", include=())
    return _listed(hits.withColumn("distance", F.round("distance", 9)), similarity(F.col("distance")).alias("similarity"))


def batch_sql(metric: str, source: str = "v", where: str = "TRUE", k: int = K) -> str:
    measure, order = MEASURE[metric]
    return f"""WITH {RECORDS}, {VECTORS}, m AS (
      SELECT CAST(q._id AS BIGINT) AS query_id, x._id, {measure} AS d FROM {source} x, v q WHERE x.embedding IS NOT NULL AND ({where})),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d {order}, _id) AS rank FROM m)
    SELECT query_id, rank, _id, d AS distance FROM n WHERE rank <= {k}"""


for _metric in MEASURE:

    def _many(spark, sf, metric=_metric):
        hits = nearest_batch(vector_records(spark, sf), vector_queries(spark, sf), K, metric, include=())
        return _listed(hits, "query_id")

    query("knn_batch" if _metric == "cosine" else f"knn_batch_{_metric}", batch_sql(_metric))(_many)


@query("knn_grid", batch_sql("cosine"))
def knn_grid(spark, sf):
    """The batch search as a grid of tiles, which is what more queries than one block get."""
    searched, asked = vector_records(spark, sf), vector_queries(spark, sf)
    total, dimension = query_shape(asked)
    return _listed(tiles.nearest_in_grid(searched, asked, K, "cosine", total, dimension), "query_id")


@query("knn_batch_filtered", batch_sql("cosine", "r", "x.quality = 1", 5))
def knn_batch_filtered(spark, sf):
    hits = nearest_batch(records(spark, sf), vector_queries(spark, sf), 5, "cosine", {"quality": 1}, include=())
    return _listed(hits, "query_id")


@query(
    "knn_batch_documents",
    batch_sql("l2", "r", "TRUE", 3).replace("SELECT query_id, rank, _id, d AS distance FROM n", "SELECT query_id, rank, _id, d AS distance, document, metadata FROM n JOIN r USING (_id)"),
)
def knn_batch_documents(spark, sf):
    return _listed(nearest_batch(records(spark, sf), vector_queries(spark, sf), 3, "l2"), "query_id", "document", "metadata")


@query(
    "knn_nested",
    f"WITH b AS ({batch_sql('l2')}) SELECT query_id, count(*) AS n, string_agg(_id, ',' ORDER BY rank) AS ids FROM b GROUP BY query_id",
)
def knn_nested(spark, sf):
    hits = nearest_batch(vector_records(spark, sf), vector_queries(spark, sf), K, "l2", include=())
    ids = F.array_join(F.transform("hits", lambda hit: hit["_id"]), ",")
    return results.nested(hits).select("query_id", F.size("hits").cast("long").alias("n"), ids.alias("ids"))


# --- text to vector ---

HASH_DIMENSION = 64


def hashed_sql(name: str, source: str, ident: str, text: str) -> str:
    """CTE ``name(id, slot, x)``: the components that are not zero of the hashed unit vector of a text."""
    return f"""{name}_t AS (SELECT {ident} AS id, unnest({terms_of(text)}) AS term FROM {source}),
    {name}_h AS (SELECT id, md5(term) AS h FROM {name}_t),
    {name}_s AS (SELECT id, CAST('0x' || substr(h, 1, 8) AS BIGINT) % {HASH_DIMENSION} AS slot,
       sum(CASE WHEN substr(h, 9, 1) IN ('0','2','4','6','8','a','c','e') THEN 1 ELSE -1 END) AS w FROM {name}_h GROUP BY 1, 2),
    {name}_n AS (SELECT id, sqrt(CAST(sum(w * w) AS DOUBLE)) AS len FROM {name}_s GROUP BY id),
    {name} AS (SELECT s.id, s.slot, CAST(CAST(s.w / n.len AS FLOAT) AS DOUBLE) AS x
       FROM {name}_s s JOIN {name}_n n ON s.id = n.id WHERE s.w <> 0 AND n.len > 0)"""


@query("embed_hash", f"WITH {hashed_sql('h', 'documents', 'doc_id', 'text')} SELECT id AS doc_id, CAST(slot AS BIGINT) AS slot, round(x, 6) AS x FROM h")
def embed_hash(spark, sf):
    made = embed(records(spark, sf).select("_id", "document"), HashingEmbedder(HASH_DIMENSION, portable=True))
    each = made.select(F.col("_id").cast("long").alias("doc_id"), F.posexplode("embedding").alias("slot", "x"))
    return each.filter("x <> 0").select("doc_id", F.col("slot").cast("long").alias("slot"), F.round(F.col("x").cast("double"), 6).alias("x"))


@query(
    "knn_text",
    f"""WITH {hashed_sql('d', 'documents', 'CAST(doc_id AS VARCHAR)', 'text')}, {hashed_sql('q', 'benchmark', 'item_id', 'text')},
    dl AS (SELECT id, sqrt(sum(x * x)) AS len FROM d GROUP BY id), ql AS (SELECT id, sqrt(sum(x * x)) AS len FROM q GROUP BY id),
    dots AS (SELECT q.id AS query_id, d.id AS _id, sum(q.x * d.x) AS dot FROM q JOIN d ON q.slot = d.slot GROUP BY 1, 2),
    m AS (SELECT ql.id AS query_id, dl.id AS _id, round(greatest(1.0 - coalesce(dot, 0.0) / (ql.len * dl.len), 0.0), 9) AS c
      FROM ql CROSS JOIN dl LEFT JOIN dots ON dots.query_id = ql.id AND dots._id = dl.id),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c, _id) AS rank FROM m)
    SELECT query_id, rank, _id, c AS distance FROM n WHERE rank <= {K}""",
)
def knn_text(spark, sf):
    embedder = HashingEmbedder(HASH_DIMENSION, portable=True)
    searched = embed(records(spark, sf).select("_id", "document", "metadata"), embedder)
    queries = embed(text_queries(spark, sf), embedder, "text", "vector")
    return _listed(nearest_batch(searched, queries, K, "cosine", include=()), "query_id")


# --- approximate nearest neighbours ---

CELLS = """c AS (SELECT label AS cell, array_agg(m ORDER BY i) AS center FROM (
      SELECT label, i, avg(x) AS m FROM (
        SELECT label, unnest(range(1, 65)) AS i, unnest(list_transform(embedding, lambda x: x / sqrt(list_inner_product(embedding, embedding)))) AS x FROM v)
      GROUP BY label, i) GROUP BY label),
    p AS (SELECT v._id, v.embedding, c.cell, row_number() OVER (PARTITION BY v._id ORDER BY list_distance(
        list_transform(v.embedding, lambda x: x / sqrt(list_inner_product(v.embedding, v.embedding))), c.center), c.cell) AS near
      FROM v, c)"""


def class_cells(spark, sf):
    """One cell per class of vectors, centred on the mean of its unit vectors."""
    unit = approximate.unit_column("embedding", "cosine")
    parts = table(spark, sf, "embeddings").select("label", F.posexplode(unit).alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg("x").alias("m"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda part: part["m"])
    centres = means.groupBy("label").agg(ordered.alias("vector")).select(F.col("label").cast("long").alias("cell"), "vector")
    # one row for each class: a model, as training gives it
    return spark.createDataFrame(centres.collect(), centres.schema)


def cells_sql(probes: int) -> str:
    return f"""WITH {VECTORS}, {CELLS}, m AS (
      SELECT CAST(q._id AS BIGINT) AS query_id, x._id, {MEASURE['cosine'][0]} AS d
      FROM p q JOIN p x ON x.cell = q.cell WHERE q.near <= {probes} AND x.near = 1),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, _id) AS rank FROM m)
    SELECT query_id, rank, _id, d AS distance FROM n WHERE rank <= {K}"""


def _in_cells(spark, sf, probes):
    searched, cells = vector_records(spark, sf), class_cells(spark, sf)
    indexed = approximate.build_cells(searched, cells, 64)
    return approximate.nearest_in_cells(indexed, cells, vector_queries(spark, sf), probes, K, include=())


@query("knn_ivf", cells_sql(3))
def knn_ivf(spark, sf):
    return _listed(_in_cells(spark, sf, 3), "query_id")


@query("knn_ivf_all_cells", batch_sql("cosine"))
def knn_ivf_all_cells(spark, sf):
    return _listed(_in_cells(spark, sf, 10), "query_id")


@query("knn_ivf_stored", cells_sql(2))
def knn_ivf_stored(spark, sf):
    folder, cells = shared_folder(spark), class_cells(spark, sf)
    approximate.write_cells(approximate.build_cells(vector_records(spark, sf), cells, 64), folder)
    hits = approximate.nearest_in_cells(spark.read.parquet(folder), cells, vector_queries(spark, sf), 2, K, include=())
    return _listed(hits, "query_id")


@query("knn_ivf_trained")
def knn_ivf_trained(spark, sf):
    searched = vector_records(spark, sf)
    cells = approximate.train_cells(searched, 16, 64)
    indexed = approximate.build_cells(searched, cells, 64)
    return _listed(approximate.nearest_in_cells(indexed, cells, vector_queries(spark, sf), 4, K, include=()), "query_id")


@query(
    "knn_ivf_pairs",
    f"""WITH {VECTORS}, {CELLS}
    SELECT count(*) AS compared, (SELECT count(*) * count(*) FROM v) AS pairs, count(*) < 0.4 * (SELECT count(*) * count(*) FROM v) AS saves
    FROM p q JOIN p x ON x.cell = q.cell WHERE q.near <= 3 AND x.near = 1""",
)
def knn_ivf_pairs(spark, sf):
    """How many distances ``knn_ivf`` takes, as its tasks count them."""
    searched, asked, cells = vector_records(spark, sf), vector_queries(spark, sf), class_cells(spark, sf)
    indexed = approximate.build_cells(searched, cells, 64)
    found = approximate.search_cells(indexed, cells, asked, 3, K, "cosine", 64)
    return _counted(found, searched, asked).withColumn("saves", F.col("compared") < F.col("pairs") * 0.4)


def _counted(found, searched, asked):
    pairs = F.lit(searched.count() * asked.count()).cast("long")
    return found.compared.agg(F.sum("compared").alias("compared")).withColumn("pairs", pairs)


def _report(spark, sf, found, hits):
    """``compared, pairs, share, recall`` of an approximate search of all vectors for all vectors."""
    searched, asked = vector_records(spark, sf), vector_queries(spark, sf)
    exact = nearest_batch(searched, asked, K, "cosine", include=())
    shares = approximate.recall(hits, exact).agg((F.sum("found") / F.sum("k")).alias("recall"))
    counted = _counted(found, searched, asked).withColumn("share", F.col("compared") / F.col("pairs"))
    return counted.crossJoin(F.broadcast(shares))  # one row each


def _hashed(spark, sf):
    searched = vector_records(spark, sf)
    return hashing.search_buckets(searched, hashing.calibrate(searched, 64), vector_queries(spark, sf), 64, K, "cosine")


@query("knn_lsh")
def knn_lsh(spark, sf):
    return _listed(_hashed(spark, sf).ranked(K, "cosine"), "query_id")


@query("knn_lsh_report")
def knn_lsh_report(spark, sf):
    found = _hashed(spark, sf)
    return _report(spark, sf, found, found.ranked(K, "cosine"))


PARTS, AGAIN = 16, 100


def _coded(spark, sf):
    searched = vector_records(spark, sf)
    books = quantised.train_codebooks(searched, 64, PARTS)
    return searched, books, written(quantised.with_codes(searched, books, 64).select("_id", "codes"))


@query("knn_pq")
def knn_pq(spark, sf):
    """The codes are stored, 16 bytes a record, and searched without the vectors."""
    searched, books, codes = _coded(spark, sf)
    return _listed(quantised.nearest_in_codes(codes, searched, books, vector_queries(spark, sf), K, AGAIN, include=()), "query_id")


@query("knn_pq_report")
def knn_pq_report(spark, sf):
    """``code_bytes, vector_bytes, recall`` of ``knn_pq``."""
    searched, books, codes = _coded(spark, sf)
    hits = quantised.nearest_in_codes(codes, searched, books, vector_queries(spark, sf), K, AGAIN, include=())
    exact = nearest_batch(searched, vector_queries(spark, sf), K, "cosine", include=())
    shares = approximate.recall(hits, exact).agg((F.sum("found") / F.sum("k")).alias("recall"))
    sizes = codes.agg(F.sum(F.octet_length("codes")).alias("code_bytes"), (F.count("*") * 64 * 4).alias("vector_bytes"))
    return sizes.crossJoin(F.broadcast(shares))  # one row each


def _asked_fiftieth(spark, sf):
    return vector_queries(spark, sf).filter(F.col("query_id") % 50 == 0)


@query(
    "knn_probes",
    f"""WITH {VECTORS}, {CELLS}, e AS (
      SELECT CAST(q._id AS BIGINT) AS query_id, x._id, row_number() OVER (PARTITION BY q._id ORDER BY {MEASURE['cosine'][0]}, x._id) AS rank
      FROM v x, v q WHERE CAST(q._id AS BIGINT) % 50 = 0),
    n AS (SELECT q.near FROM e JOIN p x ON x._id = e._id AND x.near = 1 JOIN p q ON CAST(q._id AS BIGINT) = e.query_id AND q.cell = x.cell WHERE e.rank <= {K})
    SELECT s.probes, (SELECT count(*) FROM n) AS neighbours, (SELECT count(*) FROM n WHERE near <= s.probes) AS found FROM (SELECT unnest(range(1, 11)) AS probes) s""",
)
def knn_probes(spark, sf):
    cells = class_cells(spark, sf)
    return approximate.probes_needed(approximate.build_cells(vector_records(spark, sf), cells, 64), cells, _asked_fiftieth(spark, sf), K)


@query("knn_probes_chosen")
def knn_probes_chosen(spark, sf):
    cells = class_cells(spark, sf)
    return approximate.choose_probes(approximate.build_cells(vector_records(spark, sf), cells, 64), cells, _asked_fiftieth(spark, sf), 0.6, K)


@query(
    "knn_recall",
    f"""WITH a AS ({cells_sql(3)}), b AS ({batch_sql('cosine')})
    SELECT b.query_id, count(*) AS k, count(a._id) AS found, round(count(a._id) / count(*), 6) AS recall
    FROM b LEFT JOIN a ON a.query_id = b.query_id AND a._id = b._id GROUP BY b.query_id""",
)
def knn_recall(spark, sf):
    exact = nearest_batch(vector_records(spark, sf), vector_queries(spark, sf), K, "cosine", include=())
    return approximate.recall(_in_cells(spark, sf, 3), exact).withColumn("recall", F.round("recall", 6))


# --- full-text search ---

POSTINGS = f"""tok AS (SELECT CAST(doc_id AS VARCHAR) AS _id, {terms_of('text')} AS ts FROM documents),
    each AS (SELECT _id, len(ts) AS length, unnest(ts) AS term FROM tok),
    post AS (SELECT term, _id, count(*) AS tf, any_value(length) AS length FROM each GROUP BY term, _id),
    freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    corpus AS (SELECT count(*) AS n, avg(len(ts)) AS average FROM tok)"""

WEIGHT = "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))"


@query("tokenize", f"WITH t AS (SELECT doc_id, unnest({terms_of('text')}) AS term FROM documents) SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2")
def tokenize(spark, sf):
    from hybridframe.functions.text import tokens

    each = records(spark, sf).select(F.col("_id").cast("long").alias("doc_id"), F.explode(tokens(F.col("document"))).alias("term"))
    return each.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


@query("postings", f"WITH {POSTINGS} SELECT term, _id, tf, length FROM post")
def postings(spark, sf):
    return fulltext.postings(records(spark, sf)).select("term", "_id", _whole("tf"), _whole("length"))


@query("doc_freq", f"WITH {POSTINGS} SELECT term, df FROM freq")
def doc_freq(spark, sf):
    return fulltext.document_frequencies(fulltext.postings(records(spark, sf)))


@query("corpus_stats", f"WITH {POSTINGS} SELECT n, round(average, 6) AS average FROM corpus")
def corpus_stats(spark, sf):
    return fulltext.corpus(records(spark, sf)).withColumn("average", F.round("average", 6))


def bm25_sql(terms: list[str], condition: str = "TRUE", k: int = K) -> str:
    wanted = ", ".join(f"'{t}'" for t in terms)
    return f"""WITH {RECORDS}, {POSTINGS}, s AS (
      SELECT p._id, round(sum({WEIGHT}), 6) AS score FROM post p JOIN freq USING (term), corpus WHERE p.term IN ({wanted}) GROUP BY p._id)
    SELECT row_number() OVER (ORDER BY score DESC, _id) AS rank, _id, score
    FROM s JOIN r USING (_id) WHERE {condition} ORDER BY score DESC, _id LIMIT {k}"""


BM25 = {
    "bm25_any": ({"$contains": "nicht thatand que"}, None, bm25_sql(["nicht", "thatand", "que"])),
    "bm25_string": ("die und les", None, bm25_sql(["die", "und", "les"])),
    "bm25_all": (
        {"$and": [{"$contains": "nicht auch"}, {"$contains": "der"}]},
        None,
        bm25_sql(["nicht", "auch", "der"], f"{has_any('document', 'nicht', 'auch')} AND {has_any('document', 'der')}"),
    ),
    "bm25_or": ({"$or": [{"$contains": "the"}, {"$contains": "que"}]}, None, bm25_sql(["the", "que"])),
    "bm25_filtered": ({"$contains": "the of"}, {"quality": 1, "n_chars": {"$lt": 3000}}, bm25_sql(["the", "of"], "quality = 1 AND n_chars < 3000")),
    "bm25_regex": (
        {"$regex": "[0-9]{3}"},
        None,
        f"WITH {RECORDS} SELECT row_number() OVER (ORDER BY _id) AS rank, _id, 1.0 AS score FROM r WHERE regexp_matches(document, '[0-9]{{3}}') ORDER BY _id LIMIT {K}",
    ),
}

for _name, (_text, _where, _sql) in BM25.items():

    def _ranked(spark, sf, text=_text, where=_where):
        hits = fulltext.search_text(records(spark, sf), text, K, where, ())
        return hits.select(_whole("rank"), "_id", "score")

    query(_name, _sql.replace("1.0 AS score", "CAST(1.0 AS DOUBLE) AS score"))(_ranked)


def batch_text_sql(condition: str = "TRUE") -> str:
    return f"""WITH {RECORDS}, {POSTINGS},
    qe AS (SELECT item_id AS query_id, unnest({terms_of('text')}) AS term FROM benchmark), qt AS (SELECT DISTINCT query_id, term FROM qe),
    s AS (SELECT query_id, p._id, round(sum({WEIGHT}), 6) AS score FROM qt JOIN post p USING (term) JOIN freq USING (term), corpus GROUP BY 1, 2),
    n AS (SELECT s.*, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, _id) AS rank FROM s JOIN r USING (_id) WHERE {condition})
    SELECT query_id, rank, _id, score FROM n WHERE rank <= {K}"""


def _block_index(spark, sf):
    folder = shared_folder(spark)
    blocks.write_blocks(records(spark, sf), folder)
    return blocks.read_blocks(spark, folder)


@query("bm25_blocks", BM25["bm25_any"][2])
def bm25_blocks(spark, sf):
    return blocks.search_blocks(_block_index(spark, sf), BM25["bm25_any"][0], K).select(_whole("rank"), "_id", "score")


@query("bm25_blocks_all", BM25["bm25_all"][2])
def bm25_blocks_all(spark, sf):
    return blocks.search_blocks(_block_index(spark, sf), BM25["bm25_all"][0], K).select(_whole("rank"), "_id", "score")


@query("bm25_blocks_read")
def bm25_blocks_read(spark, sf):
    """``text, blocks, reached`` of two searches: what the second job leaves out is the difference."""
    index = _block_index(spark, sf)
    one, other = (blocks.blocks_read(index, text, K).select(F.lit(text).alias("text"), "*") for text in ("nicht thatand que", "the of"))
    return one.unionByName(other)


# What the changed collection holds, in SQL: a tenth of the documents is gone, a tenth has other texts, a tenth is there twice.
AFTER = """documents_after AS (
      SELECT doc_id, CASE WHEN doc_id % 10 = 4 THEN text || ' nicht que' ELSE text END AS text FROM documents WHERE doc_id % 10 <> 3
      UNION ALL SELECT doc_id + 1000000000, text FROM documents WHERE doc_id % 10 = 5)"""


def changed_index(spark, sf):
    """A stored index, and the records that left and came since."""
    folder, searched = shared_folder(spark), records(spark, sf)
    fulltext.write_index(searched, folder)
    turn = F.col("_id").cast("long") % 10
    minus = searched.filter(turn.isin(3, 4)).select("_id", "document")
    other = searched.filter(turn == 4).select("_id", F.concat("document", F.lit(" nicht que")).alias("document"))
    added = searched.filter(turn == 5).select((F.col("_id").cast("long") + 1_000_000_000).cast("string").alias("_id"), "document")
    return deltas.text_index_after(fulltext.read_index(spark, folder), minus, other.unionByName(added))


@query(
    "bm25_after_changes",
    f"WITH {AFTER}, "
    + bm25_sql(["nicht", "thatand", "que"]).replace("WITH ", "", 1).replace("FROM documents)", "FROM documents_after)").replace("FROM s JOIN r USING (_id) WHERE TRUE", "FROM s"),
)
def bm25_after_changes(spark, sf):
    return fulltext.search_index(changed_index(spark, sf), BM25["bm25_any"][0], K).select(_whole("rank"), "_id", "score")


@query(
    "doc_freq_after_changes",
    f"WITH {AFTER}, {POSTINGS.replace('FROM documents)', 'FROM documents_after)')} SELECT term, df, n, round(average, 6) AS average FROM freq, corpus",
)
def doc_freq_after_changes(spark, sf):
    """The corrected document frequencies of all terms, with the corpus' size and mean length."""
    index = changed_index(spark, sf)
    stats = index.corpus.select(F.struct("n", "average").alias("stats")).scalar()
    return index.frequencies.withColumn("stats", stats).select("term", "df", "stats.n", F.round("stats.average", 6).alias("average"))


def _scored(hits):
    return hits.select("query_id", _whole("rank"), "_id", "score")


@query("bm25_batch", batch_text_sql())
def bm25_batch(spark, sf):
    return _scored(fulltext.search_text_batch(records(spark, sf), text_queries(spark, sf), K, include=()))


@query("bm25_batch_filtered", batch_text_sql("lang = 'en' AND toxic = 0"))
def bm25_batch_filtered(spark, sf):
    return _scored(fulltext.search_text_batch(records(spark, sf), text_queries(spark, sf), K, {"lang": "en", "toxic": 0}, ()))


@query("bm25_indexed", batch_text_sql())
def bm25_indexed(spark, sf):
    folder = shared_folder(spark)
    fulltext.write_index(records(spark, sf), folder)
    index = fulltext.read_index(spark, folder)
    return _scored(fulltext.search_index_batch(index, text_queries(spark, sf), K))


@query("bm25_index_all", BM25["bm25_all"][2])
def bm25_index_all(spark, sf):
    folder = shared_folder(spark)
    fulltext.write_index(records(spark, sf), folder)
    return fulltext.search_index(fulltext.read_index(spark, folder), BM25["bm25_all"][0], K).select(_whole("rank"), "_id", "score")


@query("bm25_index_filtered", BM25["bm25_filtered"][2])
def bm25_index_filtered(spark, sf):
    folder = shared_folder(spark)
    fulltext.write_index(records(spark, sf), folder)
    text, where, _ = BM25["bm25_filtered"]
    passing = select_records(records(spark, sf), where=where)
    return fulltext.search_index(fulltext.read_index(spark, folder), text, K, passing).select(_whole("rank"), "_id", "score")


# --- hybrid search ---


def _leg_text(terms: list[str], where: str, limit: int, condition: str = "TRUE") -> str:
    return f"""t AS (SELECT row_number() OVER (ORDER BY score DESC, _id) AS rank, _id, score FROM (
      SELECT p._id, round(sum({WEIGHT}), 6) AS score FROM post p JOIN freq USING (term), corpus
      WHERE p.term IN ({", ".join(f"'{t}'" for t in terms)}) GROUP BY p._id) JOIN r USING (_id) WHERE {where} ORDER BY score DESC, _id LIMIT {limit})"""


def _leg_knn(where: str, k: int, name: str = "g", number: int = 7) -> str:
    measure = MEASURE["cosine"][0]
    return f"""{name} AS (SELECT row_number() OVER (ORDER BY d, _id) AS rank, _id, d FROM (
      SELECT x._id, {measure} AS d FROM r x, v q WHERE q._id = '{number}' AND x.embedding IS NOT NULL AND ({where})) ORDER BY d, _id LIMIT {k})"""


def _fused(window: int, constant: int, n: int, knn: str = "g") -> str:
    return f"""SELECT row_number() OVER (ORDER BY score DESC, _id) AS rank, _id, score, text_rank, knn_rank, d AS distance FROM (
      SELECT coalesce(t._id, {knn}._id) AS _id, t.rank AS text_rank, {knn}.rank AS knn_rank, d,
        round(coalesce(1.0 / ({constant} + t.rank), 0) + coalesce(1.0 / ({constant} + {knn}.rank), 0), 9) AS score
      FROM (SELECT * FROM t WHERE rank <= {window}) t FULL OUTER JOIN (SELECT * FROM {knn} WHERE rank <= {window}) {knn} ON t._id = {knn}._id)
    ORDER BY score DESC, _id LIMIT {n}"""


def _shown(hits, *more):
    return hits.select(
        *more, _whole("rank"), "_id", "score", _whole("text_rank"), _whole("knn_rank"), "distance"
    )


@query(
    "hybrid_scalar",
    f"WITH {RECORDS} SELECT row_number() OVER (ORDER BY _id) AS rank, _id, metadata FROM r WHERE lang = 'de' AND quality = 1 ORDER BY _id LIMIT {K}",
)
def hybrid_scalar(spark, sf):
    hits = hybrid_search(records(spark, sf), query={"where": {"lang": "de", "quality": 1}}, n_results=K)
    return hits.select(_whole("rank"), "_id", "metadata")


@query("hybrid_text", bm25_sql(["the", "of"], "lang = 'en'").replace("_id, score", "_id, score, document"))
def hybrid_text(spark, sf):
    hits = hybrid_search(records(spark, sf), query={"where_document": {"$contains": "the of"}, "where": {"lang": "en"}}, n_results=K)
    return hits.select(_whole("rank"), "_id", "score", "document")


@query("hybrid_knn", nearest_sql("cosine", "r", "x.toxic = 0"))
def hybrid_knn(spark, sf):
    knn = {"query_embeddings": vector_of(spark, sf, 7), "where": {"toxic": 0}, "n_results": K}
    return _listed(hybrid_search(records(spark, sf), knn=knn, n_results=K, include=()))


@query("hybrid_rrf", f"WITH {RECORDS}, {VECTORS}, {POSTINGS}, {_leg_text(['the', 'of'], 'TRUE', 60)}, {_leg_knn('TRUE', 50)} {_fused(60, 60, K)}")
def hybrid_rrf(spark, sf):
    hits = hybrid_search(
        records(spark, sf),
        {"where_document": {"$contains": "the of"}},
        {"query_embeddings": vector_of(spark, sf, 7), "n_results": 50},
        {"rrf": {}},
        K,
        (),
    )
    return _shown(hits)


@query("hybrid_rrf_params", f"WITH {RECORDS}, {VECTORS}, {POSTINGS}, {_leg_text(['the', 'of'], 'TRUE', 20)}, {_leg_knn('TRUE', 50)} {_fused(20, 10, 15)}")
def hybrid_rrf_params(spark, sf):
    hits = hybrid_search(
        records(spark, sf),
        {"where_document": {"$contains": "the of"}},
        {"query_embeddings": vector_of(spark, sf, 7), "n_results": 50},
        {"rrf": {"rank_window_size": 20, "rank_constant": 10}},
        15,
        (),
    )
    return _shown(hits)


@query(
    "hybrid_split_filters",
    f"WITH {RECORDS}, {VECTORS}, {POSTINGS}, {_leg_text(['the', 'on'], 'quality = 1', 30)}, {_leg_knn('x.n_chars > 800', 40)} {_fused(60, 60, K)}",
)
def hybrid_split_filters(spark, sf):
    hits = hybrid_search(
        records(spark, sf),
        {"where_document": {"$contains": "the on"}, "where": {"quality": 1}, "n_results": 30},
        {"query_embeddings": vector_of(spark, sf, 7), "where": {"n_chars": {"$gt": 800}}, "n_results": 40},
        None,
        K,
        (),
    )
    return _shown(hits)


@query(
    "hybrid_batch",
    f"""WITH {RECORDS}, {VECTORS}, {POSTINGS}, {_leg_text(['the', 'of'], "lang = 'en'", 60)},
    gm AS (SELECT CAST(q._id AS BIGINT) AS query_id, x._id, {MEASURE['cosine'][0]} AS d FROM r x, v q WHERE x.embedding IS NOT NULL),
    g AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, _id) AS rank FROM gm),
    u AS (SELECT query_id, _id, rank AS knn_rank, NULL AS text_rank, d FROM g WHERE rank <= 10
      UNION ALL SELECT q.query_id, t._id, NULL, t.rank, NULL FROM t, (SELECT DISTINCT query_id FROM g) q),
    f AS (SELECT query_id, _id, round(sum(1.0 / (60 + coalesce(knn_rank, text_rank))), 9) AS score,
      max(text_rank) AS text_rank, max(knn_rank) AS knn_rank, max(d) AS d FROM u GROUP BY query_id, _id),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, _id) AS rank FROM f)
    SELECT query_id, rank, _id, score, text_rank, knn_rank, d AS distance FROM n WHERE rank <= {K}""",
)
def hybrid_batch(spark, sf):
    hits = hybrid_search(
        records(spark, sf),
        {"where_document": {"$contains": "the of"}, "where": {"lang": "en"}},
        {"query_embeddings": vector_queries(spark, sf)},
        {"rrf": {}},
        K,
        (),
    )
    return _shown(hits, "query_id")
