"""Benchmark and generator rows to conversations; grading by task name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.text import count_of, draw, seeded_hash
from shardloom.operators.ordered import shuffled_positions
from shardloom.session import materialize
from shardloom.sources.conversations import parts_message, plain_message

# Answer letters, MMLU subjects.
MMLU_LETTERS = ("A", "B", "C", "D")
MMLU_SUBJECTS = (
    "abstract_algebra", "anatomy", "astronomy", "business_ethics", "clinical_knowledge",
    "college_biology", "college_chemistry", "college_computer_science", "college_mathematics",
    "college_medicine", "college_physics", "computer_security", "conceptual_physics",
    "econometrics", "electrical_engineering", "elementary_mathematics", "formal_logic",
    "global_facts", "high_school_biology", "high_school_chemistry",
    "high_school_computer_science", "high_school_european_history", "high_school_geography",
    "high_school_government_and_politics", "high_school_macroeconomics",
    "high_school_mathematics", "high_school_microeconomics", "high_school_physics",
    "high_school_psychology", "high_school_statistics", "high_school_us_history",
    "high_school_world_history", "human_aging", "human_sexuality", "international_law",
    "jurisprudence", "logical_fallacies", "machine_learning", "management", "marketing",
    "medical_genetics", "miscellaneous", "moral_disputes", "moral_scenarios", "nutrition",
    "philosophy", "prehistory", "professional_accounting", "professional_law",
    "professional_medicine", "professional_psychology", "public_relations",
    "security_studies", "sociology", "us_foreign_policy", "virology", "world_religions",
)

# Question wordings of the letter-count task.
COUNT_TEMPLATES = (
    "How many {letter} are in the word {word}",
    "How many {letter} are in {word}",
    "Count the number of {letter} in {word}",
    "How many times does {letter} appear in {word}",
    "What's the count of {letter} in {word}",
    "In the word {word}, how many {letter} are there",
    "How many letter {letter} are in the word {word}",
    "Count how many {letter} appear in {word}",
    "Tell me the number of {letter} in {word}",
    "How many occurrences of {letter} are in {word}",
    "Find the count of {letter} in {word}",
    "Can you count the {letter} letters in {word}",
    "What is the frequency of {letter} in {word}",
    "How many {letter}s are in {word}",
    "How many {letter}'s are in {word}",
    "Count all the {letter} in {word}",
    "How many times is {letter} in {word}",
    "Number of {letter} in {word}",
    "Total count of {letter} in {word}",
    "How many {letter} does {word} have",
    "How many {letter} does {word} contain",
    "What's the number of {letter} in {word}",
    "{word} has how many {letter}",
    "In {word}, count the {letter}",
    "How many {letter} appear in {word}",
    "Count the {letter} in {word}",
    "Give me the count of {letter} in {word}",
    "How many instances of {letter} in {word}",
    "Show me how many {letter} are in {word}",
    "Calculate the number of {letter} in {word}",
    "¿Cuántas {letter} hay en {word}?",
    "¿Cuántas veces aparece {letter} en {word}?",
    "Cuenta las {letter} en {word}",
    "¿Cuántas letras {letter} tiene {word}?",
    "{word}中有多少个{letter}",
    "{word}里有几个{letter}",
    "数一下{word}中的{letter}",
    "{word}这个词里有多少{letter}",
    "{word}에 {letter}가 몇 개 있나요",
    "{word}에서 {letter}의 개수는",
    "{word}에 {letter}가 몇 번 나오나요",
    "{word}라는 단어에 {letter}가 몇 개",
    "Combien de {letter} dans {word}",
    "Combien de fois {letter} apparaît dans {word}",
    "Compte les {letter} dans {word}",
    "Wie viele {letter} sind in {word}",
    "Wie oft kommt {letter} in {word} vor",
    "Zähle die {letter} in {word}",
    "{word}に{letter}は何個ありますか",
    "{word}の中に{letter}がいくつ",
    "{word}に{letter}が何回出てくる",
)
# Fixed value: letters that the letter-count task draws from.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def conversation_columns(
    task: str,
    messages: Column,
    letters: Column | None = None,
    subject: Column | None = None,
    entry_point: Column | None = None,
    test: Column | None = None,
) -> list[Column]:
    """The common conversation row; extras a task lacks are null."""
    null = F.lit(None)
    pick = lambda c, kind: (null if c is None else c).cast(kind)
    return [
        F.lit(task).alias("task"),
        F.col("idx").cast("bigint").alias("idx"),
        messages.alias("messages"),
        pick(letters, "array<string>").alias("letters"),
        pick(subject, "string").alias("subject"),
        pick(entry_point, "string").alias("entry_point"),
        pick(test, "string").alias("test"),
    ]


# --- adapters ----------------------------------------------------------------


def render_mc(question: Column, letters: Column, choices: Column) -> Column:
    """The multiple-choice prompt: the letter follows its choice without a blank."""
    # The texts around question and choices.
    line = lambda choice, letter: F.concat(F.lit("- "), choice, F.lit("="), letter, F.lit("\n"))
    n = F.least(F.size(choices), F.size(letters))
    options = F.zip_with(F.slice(choices, F.lit(1), n), F.slice(letters, F.lit(1), n), line)
    return F.concat(
        F.lit("Multiple Choice question: "), question, F.lit("\n"), F.array_join(options, ""),
        F.lit("\nRespond only with the letter of the correct answer."),
    )


def _ask(question: Column, answer: Column) -> Column:
    return F.array(plain_message("user", question), plain_message("assistant", answer))


def mmlu_conversations(rows: DataFrame, task: str = "MMLU") -> DataFrame:
    """Rows ``idx, question, choices, answer, subject``; four choices are required."""
    letters = F.array(*[F.lit(x) for x in MMLU_LETTERS])
    checked = rows.where(
        F.when(F.size("choices") == 4, True).otherwise(F.raise_error(F.lit("MMLU needs 4 choices")).cast("boolean"))
    )
    prompt = render_mc(F.col("question"), letters, F.col("choices"))
    return checked.select(
        *conversation_columns(
            task, _ask(prompt, F.element_at(letters, F.col("answer") + 1)), letters, F.col("subject")
        )
    )


def unknown_subjects(rows: DataFrame) -> DataFrame:
    """Subjects of MMLU rows that the benchmark does not have, with their numbers of rows; null counts as one."""
    known = F.coalesce(F.col("subject").isin(*MMLU_SUBJECTS), F.lit(False))
    return rows.where(~known).groupBy("subject").agg(F.count("*").alias("n"))


def arc_conversations(rows: DataFrame, task: str = "ARC-Easy") -> DataFrame:
    """Rows ``idx, question, choices{text, label}, answer_key``; labels come from the row."""
    labels = F.col("choices")["label"]
    known = F.when(F.array_contains(labels, F.col("answer_key")), True).otherwise(
        F.raise_error(F.concat(F.lit("ARC answer without a label: "), "answer_key")).cast("boolean")
    )
    prompt = render_mc(F.col("question"), labels, F.col("choices")["text"])
    return rows.where(known).select(
        *conversation_columns(task, _ask(prompt, F.col("answer_key")), labels)
    )


def tool_parts(answer: Column) -> Column:
    """Answer text as parts: text, and a call with its output for each ``<<a=b>>``."""
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))

    def pieces_of(text: Column) -> Column:
        inner = F.substring(text, F.lit(3), F.length(text) - 4)
        last = F.substring_index(inner, "=", -1)
        has_result = F.contains(inner, F.lit("="))
        call = F.when(has_result, F.substring(inner, F.lit(1), F.length(inner) - F.length(last) - 1)).otherwise(inner)
        output = F.when(has_result, last).otherwise(F.lit(""))
        is_call = text.startswith("<<") & text.endswith(">>") & (F.length(text) >= 4)
        return F.when(is_call, F.array(part("python", call), part("python_output", output))).otherwise(
            F.array(part("text", text))
        )

    tag = "<<[^>]+>>"
    texts = F.split(answer, tag, -1)
    tags = F.regexp_extract_all(answer, F.lit(tag), F.lit(0))
    woven = F.flatten(
        F.transform(
            texts,
            lambda t, i: F.when(i < F.size(tags), F.array(t, F.get(tags, i))).otherwise(F.array(t)),
        )
    )
    return F.flatten(F.transform(woven, pieces_of))


def gsm8k_conversations(rows: DataFrame, task: str = "GSM8K") -> DataFrame:
    """Rows ``idx, question, answer`` with calculator tags in the answer."""
    messages = F.array(
        plain_message("user", F.col("question")),
        parts_message("assistant", tool_parts(F.col("answer"))),
    )
    return rows.select(*conversation_columns(task, messages))


def humaneval_conversations(rows: DataFrame, task: str = "HumanEval") -> DataFrame:
    """Rows ``idx, prompt, canonical_solution, entry_point, test``."""
    whole = F.concat("prompt", F.lit("\n"), "canonical_solution")
    return rows.select(
        *conversation_columns(
            task, _ask(F.col("prompt"), whole), entry_point=F.col("entry_point"), test=F.col("test")
        )
    )


def chat_conversations(rows: DataFrame, task: str = "SmolTalk") -> DataFrame:
    """Rows ``idx, messages``: passed through."""
    return rows.select(*conversation_columns(task, F.col("messages")))


# --- generators --------------------------------------------------------------


def index_words(words: DataFrame, order: str = "bee") -> DataFrame:
    """Distinct words with a dense index in a hash order named ``order``.

    Written once: generators look words up and need their number.
    """
    distinct = words.select("word").distinct()
    return materialize(shuffled_positions(distinct, seeded_hash(order, F.col("word")), "word_idx"), "words")


def _pick_words(spark: SparkSession, words: DataFrame, size: int, split: str, salt: str) -> DataFrame:
    if split not in ("train", "test"):
        raise ValueError("split must be train|test")
    n_words = words.count()
    chosen = spark.range(size).select(
        F.col("id").alias("idx"),
        draw(seeded_hash(salt, split, F.col("id"), "word"), n_words).alias("word_idx"),
    )
    return chosen.join(words, "word_idx")


def letter_count_rows(spark: SparkSession, words: DataFrame, size: int, split: str) -> DataFrame:
    """The draws of the letter-count task: word, letter, count, question.

    ``words`` comes from :func:`index_words`. Every draw is a hash of the split
    name and the example number, so rows are independent and reproducible.
    """
    number = lambda slot, bound: draw(seeded_hash("bee", split, F.col("idx"), slot), bound)
    rows = _pick_words(spark, words, size, split, "bee")
    own = F.substring(F.col("word"), (number("at", F.length("word")) + 1).cast("int"), F.lit(1))
    other = F.substring(F.lit(LETTERS), (number("any", 26) + 1).cast("int"), F.lit(1))
    templates = F.array(*[F.lit(t) for t in COUNT_TEMPLATES])
    quotes = F.array(F.lit(""), F.lit("'"), F.lit('"'))
    quoted = lambda slot, text: F.concat(F.get(quotes, number(slot, 3)), text, F.get(quotes, number(slot, 3)))
    template = F.get(templates, number("template", len(COUNT_TEMPLATES)))
    rows = rows.withColumn("letter", F.when(number("own", 10) < 9, own).otherwise(other))
    rows = rows.withColumn("count", count_of(F.col("word"), F.col("letter")))
    worded = F.when(number("lower", 10) < 3, F.lower(template)).otherwise(template)
    # The word goes in first: it holds no brace, so the letter's place stays unique.
    filled = F.replace(
        F.replace(worded, F.lit("{word}"), quoted("quote_word", F.col("word"))),
        F.lit("{letter}"), quoted("quote_letter", F.col("letter")),
    )
    question = F.concat(filled, F.when(number("mark", 2) < 1, "?").otherwise(""))
    return rows.select("idx", "word", "letter", "count", question.alias("question"))


def letter_count_conversations(
    spark: SparkSession, words: DataFrame, size: int, split: str, task: str = "SpellingBee"
) -> DataFrame:
    rows = letter_count_rows(spark, words, size, split)
    word, letter, count = F.col("word"), F.col("letter"), F.col("count").cast("string")
    chars = F.split(word, "")

    def step(char: Column, i: Column) -> Column:
        so_far = count_of(F.substring(word, F.lit(1), i + 1), letter).cast("string")
        place = F.concat((i + 1).cast("string"), F.lit(":"), char)
        return F.when(
            char == letter, F.concat(place, F.lit(" hit! count="), so_far, F.lit("\n"))
        ).otherwise(F.concat(place, F.lit("\n")))

    # The texts of the worked answer.
    manual = F.concat(
        F.lit("We are asked to find the number '"), letter, F.lit("' in the word '"), word,
        F.lit("'. Let me try a manual approach first.\n\nFirst spell the word out:\n"),
        word, F.lit(":"), F.array_join(chars, ","),
        F.lit("\n\nThen count the occurrences of '"), letter, F.lit("':\n"),
        F.array_join(F.transform(chars, step), ""),
        F.lit("\nThis gives us "), count, F.lit("."),
    )
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    parts = F.array(
        part("text", manual),
        part("text", F.lit("\n\nLet me double check this using Python:\n\n")),
        part("python", F.concat(F.lit("'"), word, F.lit("'.count('"), letter, F.lit("')"))),
        part("python_output", count),
        part(
            "text",
            F.concat(
                F.lit("\n\nPython gives us "), count,
                F.lit(".\n\nMy final answer is:\n\n#### "), count,
            ),
        ),
    )
    messages = F.array(plain_message("user", F.col("question")), parts_message("assistant", parts))
    return rows.select(*conversation_columns(task, messages))


def spelling_conversations(
    spark: SparkSession, words: DataFrame, size: int, split: str, task: str = "SimpleSpelling"
) -> DataFrame:
    """``Spell the word: w`` answered by ``w:`` and its letters."""
    rows = _pick_words(spark, words, size, split, "spell")
    answer = F.concat("word", F.lit(":"), F.array_join(F.split("word", ""), ","))
    return rows.select(
        *conversation_columns(task, _ask(F.concat(F.lit("Spell the word: "), "word"), answer))
    )


# --- task registry -----------------------------------------------------------


@dataclass(frozen=True)
class Task:
    """What a user adds to plug in a task: an adapter, a split and a way to grade."""

    name: str
    eval_type: str  # generative | categorical
    split: str
    to_conversations: Callable[[DataFrame], DataFrame] | None = None


TASKS: dict[str, Task] = {}


def register_task(task: Task) -> None:
    if task.eval_type not in ("generative", "categorical"):
        raise ValueError(f"unsupported evaluation type {task.eval_type!r}")
    TASKS[task.name] = task


def find_task(name: str) -> Task:
    if name not in TASKS:
        raise ValueError(f"unknown task {name!r}; known: {sorted(TASKS)}")
    return TASKS[name]


for _task in (
    Task("HumanEval", "generative", "test", humaneval_conversations),
    Task("MMLU", "categorical", "test", mmlu_conversations),
    Task("ARC-Easy", "categorical", "test", arc_conversations),
    Task("ARC-Challenge", "categorical", "test", arc_conversations),
    Task("GSM8K", "generative", "test", gsm8k_conversations),
    Task("SpellingBee", "generative", "test"),
):
    register_task(_task)


def task_table(spark: SparkSession) -> DataFrame:
    rows = [(t.name, t.eval_type, t.split) for t in TASKS.values()]
    return spark.createDataFrame(rows, "task string, eval_type string, split string")
