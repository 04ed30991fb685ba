"""Inputs for the registered queries, derived from the given tables.

The texts are ``documents`` with a link, a tag, a user name, a question mark and
emoji appended; labels come from ``labels``. Side tables (lexicons, vectors,
translations) are derived from the words of the corpus by hashing each word, so
they grow with it, and no ranking over the whole vocabulary is needed. The same
text is valid for Spark and for the checking database, apart from the functions
in ``DIALECT``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quillspark.plans.features import Resources
from quillspark.session import spread, stage

BASE_TABLES = ["documents", "labels", "embeddings", "benchmark"]

# Functions whose spelling differs: (Spark, check database).
DIALECT = {
    "@HASH@": (
        "CAST(conv(substr(md5(w), 1, 7), 16, 10) AS BIGINT)",
        "CAST('0x' || substr(md5(w), 1, 7) AS BIGINT)",
    ),
    "@WORDS@": (
        r"explode(regexp_extract_all(lower(text), r'\p{L}+', 0))",
        r"unnest(regexp_extract_all(lower(text), '\p{L}+'))",
    ),
    "@EACH@": ("explode", "unnest"),
    "@TAB@": (r"'\t'", "chr(9)"),
    "@ANY@": ("any_value", "any_value"),
}

_EMOTION = (
    "CASE {h} % 10 WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' WHEN 2 THEN 'anger' "
    "WHEN 3 THEN 'anticipation' WHEN 4 THEN 'disgust' WHEN 5 THEN 'fear' WHEN 6 THEN 'joy' "
    "WHEN 7 THEN 'sadness' WHEN 8 THEN 'surprise' ELSE 'trust' END"
)
_FIRST = _EMOTION.format(h="h")
_SECOND = _EMOTION.format(h="(h + 3)")

# Each view may use the views before it.
VIEWS = {
    "posts": """
        SELECT doc_id AS id, lang AS language, source,
          concat(text, ' http://t.test/', doc_id, ' #', source, ' @user', doc_id % 50, ' why? ',
            CASE lang WHEN 'en' THEN 'At 10:30 \U0001F642' WHEN 'es' THEN 'snake_case \U0001F621\U0001F621!'
              ELSE '\U0001F44D' END) AS text
        FROM documents""",
    "tweets": """
        SELECT p.id, p.text, p.language, p.source, l.toxic AS HS,
          CAST(l.toxic * (p.id % 2) AS INT) AS TR,
          CAST(l.toxic * CASE WHEN p.id % 3 = 0 THEN 0 ELSE 1 END AS INT) AS AG,
          CASE WHEN p.id % 10 < 7 THEN 'train' WHEN p.id % 10 = 7 THEN 'validation' ELSE 'test' END AS split
        FROM posts p JOIN labels l ON p.id = l.doc_id""",
    "predicted": """
        SELECT id, hp AS HS, CAST(hp * (id % 2) AS INT) AS TR,
          CAST(hp * CASE WHEN id % 5 = 0 THEN 0 ELSE 1 END AS INT) AS AG
        FROM (SELECT id, CASE WHEN id % 7 = 0 THEN 1 - HS ELSE HS END AS hp FROM tweets) flipped""",
    "vocabulary": """
        SELECT lang, w, n, @HASH@ AS h
        FROM (SELECT lang, w, count(*) AS n FROM (SELECT lang, @WORDS@ AS w FROM documents) words
              GROUP BY lang, w) counted""",
    "phrases": """
        SELECT w, @HASH@ AS h FROM (
          SELECT DISTINCT w FROM (
            SELECT @EACH@(regexp_extract_all(lower(text), '([a-z]+ [a-z]+)', 1)) AS w FROM benchmark
            UNION ALL SELECT @EACH@(regexp_extract_all(lower(text), '([a-z]+, [a-z]+)', 1)) FROM benchmark) found) kept""",
    "slang": """
        SELECT w AS term, CAST(h % 5 - 2 AS INT) AS score, h AS load_order
        FROM vocabulary WHERE lang = 'en'
        UNION ALL SELECT w, CAST(2 - h % 5 AS INT), h + 1000000000
        FROM vocabulary WHERE lang = 'en' AND w LIKE 't%'
        UNION ALL SELECT w, CAST(h % 3 - 1 AS INT), h + 2000000000 FROM phrases""",
    "stop_words": "SELECT w AS word FROM vocabulary WHERE lang = 'en' AND length(w) <= 3",
    "emotions": f"""
        SELECT w AS word, {_FIRST} AS emotion FROM vocabulary WHERE lang = 'en'
        UNION ALL SELECT w, {_SECOND} FROM vocabulary WHERE lang = 'en' AND w LIKE '%e'""",
    "emotions_es": f"""
        SELECT w AS word, {_FIRST} AS emotion, upper(w) AS en_word FROM vocabulary WHERE lang = 'es'
        UNION ALL SELECT w, {_SECOND}, concat(upper(w), '2') FROM vocabulary
        WHERE lang = 'es' AND w LIKE '%e'
        UNION ALL SELECT w, {_FIRST}, upper(w) FROM vocabulary WHERE lang = 'es' AND w LIKE 'e%'""",
    "phrase_emotions": f"SELECT w AS word, {_FIRST} AS emotion FROM phrases",
    "polarity": """
        SELECT concat(w, @TAB@, 'x', @TAB@, CASE h % 6 WHEN 0 THEN 'pos' WHEN 1 THEN 'neg'
            WHEN 2 THEN concat('pos', @TAB@, 'pos') WHEN 3 THEN concat('pos', @TAB@, 'neg')
            WHEN 4 THEN concat('neg', @TAB@, 'pos') ELSE concat('neg', @TAB@, 'neg') END) AS line,
          h AS load_order
        FROM vocabulary WHERE lang = 'es'
        UNION ALL SELECT concat(w, @TAB@, 'x', @TAB@, CASE h % 2 WHEN 0 THEN 'neg' ELSE 'pos' END), h + 1000000000
        FROM vocabulary WHERE lang = 'es' AND w LIKE 'a%'""",
    "vectors": """
        SELECT v.w AS word, e.embedding AS vec
        FROM (SELECT DISTINCT w, h FROM vocabulary WHERE lang IN ('en', 'es')) v
        JOIN embeddings e ON e.vec_id = v.h % (2 * (SELECT count(*) FROM embeddings))""",
    "translations": """
        SELECT id, upper(text) AS translated_text FROM posts WHERE language = 'es' AND source <> 'src0'""",
}
DIM = 64


def render(text: str, engine: str) -> str:
    """Fill the dialect holes for ``spark`` or ``check``."""
    for hole, (spark_form, check_form) in DIALECT.items():
        text = text.replace(hole, spark_form if engine == "spark" else check_form)
    return text


def with_clause(
    query: str, engine: str = "check", extra: dict[str, str] | None = None, given: tuple[str, ...] = ()
) -> str:
    """``query`` preceded by the views it uses, directly or through other views.

    The names in ``given`` are tables already.
    """
    views = {k: v for k, v in {**VIEWS, **(extra or {})}.items() if k not in given}
    ordered: dict[str, str] = {}

    def visit(text: str) -> None:
        for name, body in views.items():
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(body.replace(name, ""))
                ordered[name] = body.strip()

    visit(query)
    parts = [f"{name} AS ({body})" for name, body in ordered.items()]
    clause = f"WITH {', '.join(parts)} " if parts else ""
    return render(clause + query, engine)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Some of ``VIEWS`` over the tables in ``sf_dir``.

    The vocabulary is counted and written once for all the views that use it.
    """
    for table in BASE_TABLES:
        base_table(spark, sf_dir, table).createOrReplaceTempView(table)
    texts = {name: with_clause(f"SELECT * FROM {name}", "spark") for name in names}
    given: tuple[str, ...] = ()
    if any("vocabulary AS (" in text for text in texts.values()):
        counted = spark.sql(with_clause("SELECT * FROM vocabulary", "spark"))
        stage(counted, "vocabulary").createOrReplaceTempView("vocabulary")
        given = ("vocabulary",)
    return [spark.sql(with_clause(f"SELECT * FROM {name}", "spark", given=given)) for name in names]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return views(spark, sf_dir, name)[0]


def resources(spark: SparkSession, sf_dir: str, language: str = "english") -> Resources:
    """Side tables of one language."""
    documents = base_table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "embedding AS vec")
    sentences = {"Document_embeddings": documents}
    if language == "english":
        names = ("emotions", "vectors", "slang", "stop_words")
        emotions, vectors, slang, stop_words = views(spark, sf_dir, *names)
        return Resources(
            emotions, vectors, DIM, slang=slang, stop_words=stop_words, document_vectors=sentences
        )
    names = ("emotions", "vectors", "polarity", "emotions_es", "translations")
    emotions, vectors, polarity, emotions_es, translations = views(spark, sf_dir, *names)
    return Resources(
        emotions, vectors, DIM, polarity=polarity, emotions_es=emotions_es.select("word", "emotion"),
        translations=translations, document_vectors=sentences,
    )
