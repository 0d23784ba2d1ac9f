"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.collocations import collocations
from shardloom.llm.common import read
from shardloom.llm.decontaminate import contaminated
from shardloom.llm.embedding_dedup import near_duplicates
from shardloom.llm.fill_in_middle import fill_in_middle, restore
from shardloom.llm.jaccard_join import join_components
from shardloom.llm.language_id import identify
from shardloom.llm.license_scan import scan_licenses
from shardloom.llm.mixing import mix_plan
from shardloom.llm.secret_scan import find_secrets
from shardloom.llm.suffix_dedup import remove_repeats
from shardloom.llm.topk_search import search
from shardloom.llm.toxicity import detect
from shardloom.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


MIX_SQL = r"""WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, list_extract([5.0::DOUBLE, 2.0, 1.0], ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT) AS w,
    source_size * 3.0::DOUBLE AS cap FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT source, source_size, least(cap, greatest(max(level) OVER (), 0) * w) AS target FROM levels),
budgets AS (SELECT *, least(floor(target + 0.5)::BIGINT, source_size * 3) AS budget FROM targets),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM budgets),
keys AS (SELECT source, key, sum(size) AS key_size, count(*) AS same,
    coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized GROUP BY source, key)
SELECT s.doc_id, s.size, p.source_size, p.target, (p.epochs * s.size +
    CASE WHEN k.before + k.key_size <= p.budget - p.epochs * p.source_size THEN s.size
         WHEN k.before >= p.budget - p.epochs * p.source_size THEN 0
         ELSE (p.budget - p.epochs * p.source_size - k.before) // k.same END)::BIGINT AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
JOIN keys k ON s.source IS NOT DISTINCT FROM k.source AND s.key = k.key"""


@query("op6_mix_to_weights", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), text=False).drop("spans")


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, strlen(body)::BIGINT AS n, sha1(body) AS hex FROM p),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body)
SELECT d.page_id, d.n AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(d.hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
    CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN d.page_id <> f.first THEN f.first END AS refers_to
FROM d JOIN f USING (body)"""


@query("op7_warc_chunk_table", WARC_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


@query("op10_ngram_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(read(spark, sf_dir, "documents"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


TOPK_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op4_exact_topk", TOPK_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


FIM_SQL = """WITH t AS (SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS told FROM documents),
h AS (SELECT *, ('0x' || substr(told, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(told, 9, 8))::BIGINT % (n + 1) AS c2,
    ('0x' || substr(told, 17, 8))::BIGINT AS h3, ('0x' || substr(told, 25, 8))::BIGINT AS h4 FROM t),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(x, 1, a) AS prefix, substr(x, a + 1, b - a) AS middle, substr(x, b + 1, n - b) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(x) AS restored_sha256 FROM p"""


@query("op12_fill_in_middle", FIM_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restore(fill_in_middle(read(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{name}_sha256") for c, name in (("output", "output"), ("restored", "restored"))]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


COLLOCATION_SQL = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM places),
ones AS (SELECT lang, w1 AS p, count(*) AS f FROM grams GROUP BY lang, w1),
twos AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10),
threes AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
longer AS (SELECT lang, p, max(f) AS f FROM (SELECT lang, w1 || ' ' || w2 AS p, f FROM threes UNION ALL SELECT lang, w2 || ' ' || w3, f FROM threes) GROUP BY lang, p),
cuts AS (SELECT t.lang, t.p, t.f AS a, 1 AS k, x.f AS l, y.f AS r FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.w1
        JOIN ones y ON y.lang = t.lang AND y.p = t.w2 LEFT JOIN longer o ON o.lang = t.lang AND o.p = t.p WHERE o.f IS NULL OR 100 * o.f < 50 * t.f
    UNION ALL SELECT t.lang, t.p, t.f, 1, x.f, y.f FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.w1
        JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
    UNION ALL SELECT t.lang, t.p, t.f, 2, x.f, y.f FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
        JOIN ones y ON y.lang = t.lang AND y.p = t.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (l::HUGEINT * r::HUGEINT))::BIGINT AS score FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS pick FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM best WHERE pick = 1),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


@query("op13_collocations", COLLOCATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


@query("op11_embedding_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
