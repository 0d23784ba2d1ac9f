"""Run metrics and reports, with the events table as the log of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardloom.operators import reports
from shardloom.plans.registry import query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _metrics(spark, sf_dir):
    """Metric rows per run: a count, a large sum, a float, a text, an absent value and plain text."""
    runs = _events(spark, sf_dir).groupBy("user_id").agg(
        F.max("ts").alias("ts"), F.count("*").alias("n"), F.sum("event_id").alias("total"),
        F.max("value").alias("top"), F.max("event_type").alias("kind_name"),
    )
    entry = lambda ord, key, kind, value: F.struct(
        F.lit(ord).alias("ord"), F.lit(key).alias("key"), F.lit(kind).alias("kind"), value.alias("value")
    )
    entries = F.array(
        entry(0, "events", "int", F.col("n").cast("string")),
        entry(1, "id total", "int", F.col("total").cast("string")),
        entry(2, "top value", "float", F.col("top").cast("string")),
        entry(3, "last kind", "str", F.col("kind_name")),
        entry(4, "notes", "str", F.lit(None).cast("string")),
        entry(5, "", "raw", F.concat(F.lit("ended as: "), F.col("kind_name"), F.lit("\n"))),
        entry(6, "", "raw", F.lit("")),
    )
    section = F.concat(F.lit("Run Log "), F.col("user_id").cast("string"))
    return runs.select(section.alias("section"), "ts", F.explode(entries).alias("e")).select("section", "ts", "e.*")


_SECTION_SQL = """r AS (SELECT user_id, max(ts) AS ts, count(*) AS n, sum(event_id)::BIGINT AS total, max(value) AS top, max(event_type) AS kind FROM events GROUP BY 1),
sec AS (SELECT user_id, 'run-log-' || user_id AS slug, 'Run Log ' || user_id AS section, '## Run Log ' || user_id || chr(10) || 'timestamp: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) || chr(10)
|| '- events: ' || CASE WHEN n >= 10000 THEN format('{:,}', n) ELSE n::VARCHAR END || chr(10) || '- id total: ' || CASE WHEN total >= 10000 THEN format('{:,}', total) ELSE total::VARCHAR END || chr(10)
|| '- top value: ' || printf('%.4f', top) || chr(10) || '- last kind: ' || kind || chr(10) || '- notes: None' || chr(10) || 'ended as: ' || kind || chr(10) || chr(10) AS text FROM r)"""


@query("report_section", f"WITH {_SECTION_SQL} SELECT slug, section, text FROM sec")
def report_section(spark, sf_dir):
    return reports.section_text(_metrics(spark, sf_dir))


@query(
    "report_extract",
    f"""WITH {_SECTION_SQL} SELECT slug, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, 'events' AS key, CASE WHEN n >= 10000 THEN format('{{:,}}', n) ELSE n::VARCHAR END AS value FROM sec JOIN r USING (user_id)
UNION ALL SELECT slug, strftime(ts, '%Y-%m-%d %H:%M:%S'), 'top value', printf('%.4f', top) FROM sec JOIN r USING (user_id)""",
)
def report_extract(spark, sf_dir):
    """Metrics and time read back from the section texts; ``value`` alone is no key."""
    sections = reports.section_text(_metrics(spark, sf_dir)).select("slug", "text")
    stamped = sections.withColumn("stamp", F.date_format(reports.extract_timestamp(F.col("text"), "timestamp:"), "yyyy-MM-dd HH:mm:ss"))
    return reports.extract_metrics(stamped, ["events", "top value", "value"])


_METRIC_SQL = "CASE event_type WHEN 'click' THEN 'CORE' WHEN 'view' THEN 'MMLU' WHEN 'purchase' THEN 'GSM8K' WHEN 'signup' THEN 'ChatCORE' ELSE 'ARC-Easy' END"


@query(
    "report_summary",
    f"""WITH m AS (SELECT {_METRIC_SQL} AS metric, CASE user_id % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'mid' WHEN 2 THEN 'sft' ELSE 'rl' END AS stage FROM events),
c AS (SELECT metric, stage, count(*)::VARCHAR AS v FROM m WHERE (stage = 'base') = (metric = 'CORE') AND (stage <> 'rl' OR metric = 'GSM8K') GROUP BY 1, 2)
SELECT metric, coalesce(max(v) FILTER (stage = 'base'), '-') AS base, coalesce(max(v) FILTER (stage = 'mid'), '-') AS mid, coalesce(max(v) FILTER (stage = 'sft'), '-') AS sft,
coalesce(max(v) FILTER (stage = 'rl'), '-') AS rl, CASE metric WHEN 'CORE' THEN 0 WHEN 'ChatCORE' THEN 2 ELSE 1 END AS place FROM c GROUP BY metric""",
)
def report_summary(spark, sf_dir):
    kinds = {"click": "CORE", "view": "MMLU", "purchase": "GSM8K", "signup": "ChatCORE"}
    metric = F.lit("ARC-Easy")
    for kind, name in kinds.items():
        metric = F.when(F.col("event_type") == kind, name).otherwise(metric)
    stage = F.get(F.array(*[F.lit(s) for s in reports.STAGES]), F.col("user_id") % 4)
    values = (
        _events(spark, sf_dir).select(metric.alias("metric"), stage.alias("stage"))
        .where(((F.col("stage") == "base") == (F.col("metric") == "CORE")) & ((F.col("stage") != "rl") | (F.col("metric") == "GSM8K")))
        .groupBy("metric", "stage").agg(F.count("*").cast("string").alias("value"))
    )
    return reports.summary_matrix(values)


@query(
    "report_wallclock",
    """WITH g AS (SELECT user_id, date_diff('second', min(ts), max(ts)) AS raw, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS s FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT user_id, s::BIGINT AS seconds, (s // 3600) || 'h' || (s % 3600 // 60) || 'm' AS wall_clock FROM g""",
)
def report_wallclock(spark, sf_dir):
    """Per run; error events stand for sections of the RL stage."""
    slug = F.when(F.col("event_type") == "error", "chat-rl").otherwise(F.col("event_type"))
    sections = _events(spark, sf_dir).select("user_id", "ts", slug.alias("slug"))
    return reports.wall_clock(sections, F.col("ts"), "user_id")


_LISTING_SQL = """l AS (SELECT ts AS modified, CASE WHEN user_id % 41 = 40 THEN 'best' ELSE 'd' || (user_id % 41) END AS tag, event_id % 5000 AS step FROM events WHERE event_id % 6 <> 0),
cat AS (SELECT tag, max(step)::INT AS last_step, strftime(max(modified), '%Y-%m-%d %H:%M:%S') AS modified, count(*) AS n_files, CASE WHEN tag = 'best' THEN -1 ELSE substr(tag, 2)::INT END AS depth FROM l GROUP BY tag)"""


def _catalog(spark, sf_dir):
    tag = F.when(F.col("user_id") % 41 == 40, "best").otherwise(F.concat(F.lit("d"), (F.col("user_id") % 41).cast("string")))
    name = F.when(F.col("event_id") % 6 == 0, "optimizer").otherwise("model")
    step = F.lpad((F.col("event_id") % 5000).cast("string"), 6, "0")
    path = F.concat(F.lit("runs/"), tag, F.lit("/"), name, F.lit("_"), step, F.lit(".pt"))
    return reports.run_catalog(_events(spark, sf_dir).select(path.alias("path"), F.col("ts").alias("modified")))


def _shown_catalog(df):
    return df.withColumn("modified", F.date_format("modified", "yyyy-MM-dd HH:mm:ss")).withColumn("depth", F.coalesce("depth", F.lit(-1)))


@query("run_catalog", f"WITH {_LISTING_SQL} SELECT * FROM cat")
def run_catalog(spark, sf_dir):
    return _shown_catalog(_catalog(spark, sf_dir))


@query("run_largest", f"WITH {_LISTING_SQL} SELECT * FROM cat ORDER BY depth DESC LIMIT 1")
def run_largest(spark, sf_dir):
    """The single deepest model is the result asked for."""
    return _shown_catalog(reports.largest_model(_catalog(spark, sf_dir)))


@query(
    "best_so_far",
    "SELECT user_id AS run, event_id AS step, value, min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best FROM events",
)
def best_so_far(spark, sf_dir):
    log = _events(spark, sf_dir).select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")
    return reports.best_so_far(log)


@query(
    "log_thin",
    "SELECT user_id AS run, event_id AS step, value FROM events WHERE event_id % 10 = 0",
)
def log_thin(spark, sf_dir):
    """Every tenth step of the training log: the thinning is the feature."""
    log = _events(spark, sf_dir).select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")
    return reports.thin_log(log, 10)


@query(
    "run_cost",
    """WITH d AS (SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'NVIDIA H100 80GB' WHEN 1 THEN 'NVIDIA A100-SXM4' WHEN 2 THEN 'Tesla V100' ELSE 'NVIDIA A40' END AS device, (user_id % 8 + 1)::INT AS n_devices, value AS hours FROM events),
r AS (SELECT *, (CASE WHEN contains(device, 'H100') THEN 3.0::DOUBLE WHEN contains(device, 'A100') THEN 1.79::DOUBLE WHEN contains(device, 'V100') THEN 0.55::DOUBLE ELSE 2.0::DOUBLE END) * n_devices::DOUBLE AS hourly_rate FROM d)
SELECT *, hourly_rate * hours AS total FROM r""",
)
def run_cost(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in ("NVIDIA H100 80GB", "NVIDIA A100-SXM4", "Tesla V100", "NVIDIA A40")])
    runs = _events(spark, sf_dir).select(
        "event_id", F.get(names, F.col("user_id") % 4).alias("device"),
        (F.col("user_id") % 8 + 1).cast("int").alias("n_devices"), F.col("value").alias("hours"),
    )
    return reports.run_cost(runs)


_SLUGS_SQL = "[" + ", ".join(f"'{s}'" for s in reports.SECTION_ORDER) + ", 'other']"


@query(
    "report_assemble",
    f"""WITH s AS (SELECT user_id, event_id % 14 AS o, coalesce(({_SLUGS_SQL})[event_id % 14 + 1], 'other') AS slug, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, 'Report of run ' || user_id || chr(10) || string_agg('## ' || slug || chr(10) || n || chr(10) || chr(10), '' ORDER BY o) || '## Summary' || chr(10) AS report
FROM s WHERE slug <> 'other' GROUP BY user_id""",
)
def report_assemble(spark, sf_dir):
    """One report per run; sections of unknown name are skipped."""
    slugs = F.array(*[F.lit(s) for s in reports.SECTION_ORDER])
    slug = F.coalesce(F.get(slugs, F.col("event_id") % 14), F.lit("other"))
    sections = _events(spark, sf_dir).groupBy("user_id", slug.alias("slug")).agg(F.count("*").alias("n"))
    text = F.concat(F.lit("## "), "slug", F.lit("\n"), F.col("n").cast("string"), F.lit("\n"))
    header = F.concat(F.lit("Report of run "), F.col("user_id").cast("string"), F.lit("\n"))
    return reports.assemble_report(sections.withColumn("text", text), header, F.lit("## Summary\n"), "user_id")
