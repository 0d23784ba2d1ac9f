"""Task-like inputs derived by Spark from the given tables, with SQL twins.

The benchmark datasets of the field are not at hand, so their row shapes are
filled from the given tables; every input grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.text import draw, seeded_hash
from shardloom.operators.chat import assemble
from shardloom.operators.vocabulary import Tokenizer, train_tokenizer
from shardloom.plans.registry import table
from shardloom.plans.sqltext import N_MERGES
from shardloom.plans.sqltext import draw as sql_draw
from shardloom.session import materialize, spread

_TOKENIZERS: dict[tuple, Tokenizer] = {}


def tokenizer(spark: SparkSession, sf_dir: str, n_merges: int = N_MERGES) -> Tokenizer:
    """The tokenizer trained on ``documents``, trained once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, n_merges)
    if key not in _TOKENIZERS:
        docs = heavy_documents(spark, sf_dir)
        _TOKENIZERS[key] = train_tokenizer(docs, 256 + n_merges, "doc_id")
    return _TOKENIZERS[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def heavy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` on all cores, for splitting and encoding."""
    return spread(documents(spark, sf_dir))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct whole words in small letters; words with other letters than a-z stay out."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    every = heavy_documents(spark, sf_dir).select(F.explode_outer(found).alias("word"))
    return every.where(F.col("word").rlike(r"^[a-z]+\z")).distinct()


WORDS_SQL = r"""words AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word
FROM documents) WHERE regexp_full_match(word, '[a-z]+'))"""


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation rows ``idx, messages``."""
    return assemble(table(spark, sf_dir, "conversations")).withColumnRenamed("conv_id", "idx")


def mmlu(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarter = F.expr("length(text) div 4").cast("int")
    cut = lambda i: F.substring(F.col("text"), quarter * i + 1, quarter if i < 3 else F.length("text"))
    return heavy_documents(spark, sf_dir).select(
        F.col("doc_id").alias("idx"),
        F.col("text").alias("question"),
        F.array(*[cut(i) for i in range(4)]).alias("choices"),
        draw(seeded_hash("mmlu", F.col("doc_id")), 4).cast("int").alias("answer"),
        F.col("source").alias("subject"),
    )


MMLU_SQL = f"""mmlu AS (SELECT doc_id AS idx, text AS question,
    [substr(text, 1, length(text) // 4), substr(text, length(text) // 4 + 1, length(text) // 4),
     substr(text, 2 * (length(text) // 4) + 1, length(text) // 4), substr(text, 3 * (length(text) // 4) + 1)] AS choices,
    {sql_draw("'mmlu|' || doc_id", 4)}::INT AS answer, source AS subject FROM documents)"""


def arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.when(F.col("p_partkey") % 2 == 0, F.array(*[F.lit(x) for x in "ABCD"])).otherwise(
        F.array(*[F.lit(x) for x in "1234"])
    )
    texts = F.array("p_brand", "p_type", "p_name", F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("idx"),
        F.concat(F.lit("What is the brand of part "), F.col("p_partkey").cast("string"), F.lit("?")).alias("question"),
        F.struct(texts.alias("text"), letters.alias("label")).alias("choices"),
        F.get(letters, draw(seeded_hash("arc", F.col("p_partkey")), 4)).alias("answer_key"),
    )


ARC_SQL = f"""arc AS (SELECT p_partkey AS idx, 'What is the brand of part ' || p_partkey || '?' AS question,
    [p_brand, p_type, p_name, p_size::VARCHAR] AS texts,
    CASE WHEN p_partkey % 2 = 0 THEN ['A', 'B', 'C', 'D'] ELSE ['1', '2', '3', '4'] END AS labels,
    (CASE WHEN p_partkey % 2 = 0 THEN ['A', 'B', 'C', 'D'] ELSE ['1', '2', '3', '4'] END)[{sql_draw("'arc|' || p_partkey", 4)} + 1] AS answer_key
    FROM part)"""


def gsm8k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worked problems about orders: right and wrong results, tags without a result, no tag."""
    a, b, kind = F.col("a").cast("string"), F.col("b").cast("string"), F.col("kind")
    number = lambda e: F.expr(e).cast("string")
    call = lambda expr, result: F.concat(F.lit("<<"), expr, F.lit("="), result, F.lit(">>"))
    product, total = number("a * b"), number("a * b + a")
    times, plus = F.concat(a, F.lit("*"), b), F.concat(product, F.lit("+"), a)
    end = lambda n: F.concat(F.lit("\n#### "), n)
    answer = (
        F.when(kind == 0, F.concat(a, F.lit(" boxes of "), b, F.lit(" make "), call(times, product), product, F.lit("."), end(product)))
        .when(kind == 1, F.concat(call(times, product), product, F.lit(" and then "), call(plus, total), end(total)))
        .when(kind == 2, F.concat(F.lit("That is "), call(times, number("a * b + 1")), F.lit(" pieces."), end(product)))
        .when(kind == 3, F.concat(F.lit("We have <<"), a, F.lit(">> each."), end(F.concat(a, F.lit(",000")))))
        .otherwise(F.lit("I cannot tell."))
    )
    return (
        spread(table(spark, sf_dir, "orders"))
        .select(
            F.col("o_orderkey").alias("idx"),
            (F.col("o_custkey") % 97 + 1).alias("a"),
            (F.col("o_orderkey") % 13 + 2).alias("b"),
            draw(seeded_hash("gsm", F.col("o_orderkey")), 5).alias("kind"),
        )
        .select(
            "idx", "a", "b", "kind",
            F.concat(F.lit("Order "), F.col("idx").cast("string"), F.lit(" has "), a, F.lit(" boxes of "), b, F.lit(". How many pieces?")).alias("question"),
            answer.alias("answer"),
        )
    )


GSM8K_SQL = f"""gsm0 AS (SELECT o_orderkey AS idx, o_custkey % 97 + 1 AS a, o_orderkey % 13 + 2 AS b,
    {sql_draw("'gsm|' || o_orderkey", 5)} AS kind FROM orders),
gsm8k AS (SELECT idx, a, b, kind, 'Order ' || idx || ' has ' || a || ' boxes of ' || b || '. How many pieces?' AS question,
    CASE kind
    WHEN 0 THEN a || ' boxes of ' || b || ' make <<' || a || '*' || b || '=' || (a*b) || '>>' || (a*b) || '.' || chr(10) || '#### ' || (a*b)
    WHEN 1 THEN '<<' || a || '*' || b || '=' || (a*b) || '>>' || (a*b) || ' and then <<' || (a*b) || '+' || a || '=' || (a*b+a) || '>>' || chr(10) || '#### ' || (a*b+a)
    WHEN 2 THEN 'That is <<' || a || '*' || b || '=' || (a*b+1) || '>> pieces.' || chr(10) || '#### ' || (a*b)
    WHEN 3 THEN 'We have <<' || a || '>> each.' || chr(10) || '#### ' || a || ',000'
    ELSE 'I cannot tell.' END AS answer FROM gsm0)"""


def humaneval(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    head = F.concat(F.lit("def f"), key, F.lit("(x):\n"))
    body = F.concat(F.lit("    return x + "), size)
    prompt = F.concat(
        F.lit("# part\nimport math\n\nfrom typing import List\n\n"), head, F.lit('    """'), F.col("p_name"),
        F.lit('"""\n    import os\n'),
    )
    code = F.concat(head, body)
    completion = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Here:\n```python\n"), code, F.lit("\n```\nor\n```\npass\n```")))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("``` \n"), code, F.lit("\n```")))
        .otherwise(F.concat(F.lit("  \n"), code, F.lit("\n ")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("idx"),
        prompt.alias("prompt"),
        body.alias("canonical_solution"),
        F.concat(F.lit("f"), key).alias("entry_point"),
        F.concat(F.lit("def check(f):\n    assert f(1) == "), (F.col("p_size") + 1).cast("string")).alias("test"),
        completion.alias("completion"),
    )


HUMANEVAL_SQL = """humaneval AS (SELECT p_partkey AS idx,
    '# part' || chr(10) || 'import math' || chr(10) || chr(10) || 'from typing import List' || chr(10) || chr(10) || head
        || '    \"\"\"' || p_name || '\"\"\"' || chr(10) || '    import os' || chr(10) AS prompt,
    body AS canonical_solution, 'f' || p_partkey AS entry_point,
    'def check(f):' || chr(10) || '    assert f(1) == ' || (p_size + 1) AS test, head || body AS code
    FROM (SELECT *, 'def f' || p_partkey || '(x):' || chr(10) AS head, '    return x + ' || p_size AS body FROM part))"""


def eval_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choice items from ``benchmark``: own second half among those of three neighbours."""
    bench = table(spark, sf_dir, "benchmark")
    n = bench.agg(F.count("*")).first()[0]
    half = F.expr("length(text) div 2").cast("int")
    halves = bench.select(
        F.col("item_id").alias("idx"),
        F.concat(F.lit("task"), (F.col("item_id") % 3).cast("string")).alias("task"),
        F.substring(F.col("text"), F.lit(1), half).alias("query"),
        F.substring(F.col("text"), half + 1, F.length("text")).alias("ending"),
        draw(seeded_hash("gold", F.col("item_id")), 4).cast("int").alias("gold"),
    )
    wanted = halves.select(
        "idx", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.pmod(F.col("idx") + j - F.col("gold"), F.lit(n)))).alias("place", "other")
    )
    choices = (
        wanted.join(halves.select(F.col("idx").alias("other"), "ending"), "other")
        .groupBy("idx")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "ending"))), lambda c: c["ending"]).alias("choices"))
    )
    return materialize(halves.join(choices, "idx"), "items")


EVAL_ITEMS_SQL = f"""halves AS (SELECT item_id AS idx, 'task' || (item_id % 3) AS task, substr(text, 1, length(text) // 2) AS query,
    substr(text, length(text) // 2 + 1) AS ending, {sql_draw("'gold|' || item_id", 4)}::INT AS gold FROM benchmark),
items AS (SELECT h.idx, h.task, h.query, h.ending, h.gold,
    list(o.ending ORDER BY p.place) AS choices FROM halves h CROSS JOIN (SELECT unnest(range(4)) AS place) p
    JOIN halves o ON o.idx = (h.idx + p.place - h.gold + (SELECT count(*) FROM halves)) % (SELECT count(*) FROM halves)
    GROUP BY ALL)"""


def token_losses(encoded: DataFrame, key: str) -> DataFrame:
    """One row per token with a reproducible loss (multiples of 1/4096)."""
    # The outer form: a plain one would make the optimizer encode twice.
    rows = encoded.select("*", F.posexplode_outer("ids").alias("pos", "target_id")).drop("ids")
    rows = rows.where(F.col("pos").isNotNull())
    loss = ((F.col(key) * 7919 + F.col("pos").cast("bigint") * 104729) % 65536) / 4096.0
    return rows.withColumn("loss", loss)


LOSS_SQL = lambda key, pos: f"((({key} * 7919 + {pos} * 104729) % 65536) / 4096.0::DOUBLE)"
