"""SQL of the registered queries for an independent engine."""

from __future__ import annotations

from quillspark.functions.normal import normal_cdf_sql
from quillspark.functions.text import BLANK, WORD, default_emoji_names
from quillspark.plans.fixtures import DIM, with_clause
from quillspark.plans.queries import MIN_COUNT, NORMALIZED, PLAIN_FEATURES
from quillspark.schemas import CLASSES, EMOTIONS, EXT_EMOTIONS, LABELS, SYMBOLS, count_column

TOKEN = f"[{WORD}]+|[^{WORD}{BLANK}]"


def _squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{BLANK}]+', ' ', 'g'))"


def _drop(x: str, start: str) -> str:
    return f"trim(regexp_replace({x}, '(?:^| ){start}[^ ]*', '', 'g'))"


def _list(x: str, start: str) -> str:
    return f"array_to_string(regexp_extract_all({x}, '(?:^| )({start}[^ ]*)', 1), ' ')"


def _users(x: str) -> str:
    return rf"regexp_replace({x}, '(^| )@[^ ]*', '\1user', 'g')"


def _count(x: str, symbol: str) -> str:
    return f"(length({x}) - length(replace({x}, '{symbol}', '')))"


def _strip_symbols(x: str) -> str:
    for symbol in SYMBOLS:
        x = f"replace({x}, '{symbol}', '')"
    return x


def _capitals(x: str) -> str:
    letters = f"length(regexp_replace({x}, '[^A-Za-z]', '', 'g'))"
    return f"coalesce(length(regexp_replace({x}, '[^A-Z]', '', 'g')) / nullif({letters}, 0)::DOUBLE, 0.0)"


def _emoji(x: str) -> str:
    names = default_emoji_names()
    for char in ("\U0001F642", "\U0001F621", "\U0001F44D"):
        x = f"replace({x}, '{char}', ':{names[char]}:')"
    return f"translate({x}, ':_', '  ')"


_COUNTS = ", ".join(f'{_count("t", s)} AS "{count_column(s)}"' for s in SYMBOLS)

# Views of the cleaning steps, on top of the fixture views.
CLEANING = {
    "squashed": f"SELECT id, language, {_squash('text')} AS t FROM posts",
    "labelled": "SELECT id, HS, TR, AG, split FROM tweets",
    "linkless": f"SELECT id, language, text, {_drop(_squash('text'), 'http')} AS t FROM posts",
    "untagged": f"SELECT id, language, text, {_list('t', '#')} AS hashtags, {_drop('t', '#')} AS t FROM linkless",
    "anonymous": f"SELECT id, language, text, hashtags, {_list('t', '@')} AS user_ids, {_users('t')} AS t FROM untagged",
    "counted": f"SELECT id, language, text, hashtags, user_ids, {_COUNTS}, {_strip_symbols('t')} AS t FROM anonymous",
    "cleaned": "SELECT id, language, text AS raw_text, hashtags, user_ids, "
    + ", ".join(f'"{count_column(s)}"' for s in SYMBOLS)
    + f", {_capitals('t')} AS percent_capitals, lower({_emoji(_squash('lower(t)'))}) AS cleaned_text FROM counted",
    "stripped_texts": f"SELECT id, {_squash('lower(t)')} AS cleaned_text FROM counted WHERE language = 'en'",
    # lexicon tables
    "last_slang": "SELECT term, arg_max(score, load_order) AS score FROM slang GROUP BY term",
    "kept_slang": "SELECT term, score FROM last_slang WHERE term NOT IN (SELECT word FROM stop_words)",
    "polarity_terms": """
        SELECT f[1] AS term, arg_max(CASE WHEN len(f) > 3 AND f[4] <> f[3] THEN 0 WHEN f[3] = 'pos' THEN 1 ELSE -1 END,
          load_order) AS score
        FROM (SELECT string_split(line, chr(9)) AS f, load_order FROM polarity) GROUP BY f[1]""",
    "runs": f"""
        SELECT id, i, r, lead(r) OVER (PARTITION BY id ORDER BY i) AS gap,
          lead(r, 2) OVER (PARTITION BY id ORDER BY i) AS r2
        FROM (SELECT id, unnest(l) AS r, unnest(range(len(l))) AS i
              FROM (SELECT id, regexp_extract_all(cleaned_text, '[{WORD}]+|[^{WORD}]+') AS l FROM cleaned))""",
    "units": f"""
        SELECT id, r AS unit FROM runs WHERE regexp_matches(r, '^[{WORD}]')
        UNION ALL SELECT id, r || gap || r2 FROM runs
        WHERE regexp_matches(r, '^[{WORD}]') AND r2 IS NOT NULL AND r <> r2
        UNION ALL SELECT id, unit FROM (
          SELECT id, unit, row_number() OVER (PARTITION BY id, unit, chain ORDER BY i) AS k FROM (
            SELECT id, r || gap || r2 AS unit, i,
              i - 2 * row_number() OVER (PARTITION BY id, r || gap || r2 ORDER BY i) AS chain
            FROM runs WHERE regexp_matches(r, '^[{WORD}]') AND r = r2)) WHERE k % 2 = 1""",
    "word_pieces": f"SELECT id, language, unnest(regexp_extract_all(cleaned_text, '{TOKEN}')) AS word FROM cleaned",
    "flagged": "SELECT DISTINCT word, emotion FROM emotions",
    "flagged_es": "SELECT DISTINCT word, emotion FROM emotions_es",
    "emotion_totals": "SELECT p.id, "
    + ", ".join(f"count(*) FILTER (emotion = '{e}') AS {e}" for e in EMOTIONS)
    + " FROM word_pieces p JOIN flagged f ON p.word = f.word WHERE p.language = 'en' GROUP BY p.id",
    "emotion_totals_es": "SELECT p.id, "
    + ", ".join(f"count(*) FILTER (emotion = '{e}') AS {e}" for e in EMOTIONS)
    + " FROM word_pieces p JOIN flagged_es f ON p.word = f.word WHERE p.language = 'es' GROUP BY p.id",
    # vectors
    "placed": f"""
        SELECT id, unnest(l) AS word, unnest(range(len(l))) AS pos FROM (
          SELECT id, string_split({_squash('cleaned_text')}, ' ') AS l FROM cleaned WHERE language = 'en')""",
    "components": f"""
        SELECT p.id, d.dim, avg(CAST(v.vec[d.dim + 1] AS DOUBLE)) AS value
        FROM placed p JOIN vectors v ON p.word = v.word, (SELECT unnest(range({DIM})) AS dim) d
        GROUP BY p.id, d.dim""",
    # evaluation
    "matched": """
        SELECT g.id, g.language, """
    + ", ".join(f"g.{x} AS {x}_x, p.{x} AS {x}_y" for x in LABELS)
    + " FROM tweets g JOIN predicted p ON g.id = p.id",
    "long_pairs": " UNION ALL ".join(
        f"SELECT language, '{x}' AS label, {x}_x AS g, {x}_y AS p FROM matched" for x in LABELS
    ),
    "targets": "SELECT id, split, CASE WHEN HS = 1 THEN 'HS' || CASE WHEN TR = 1 THEN '+TR' ELSE '' END || "
    "CASE WHEN AG = 1 THEN '+AG' ELSE '' END ELSE 'NotHS' END AS Target FROM tweets",
    # symbol counts of labelled texts with their split
    "split_counts": "SELECT c.id, l.split, "
    + ", ".join(f'c."{count_column(s)}"' for s in SYMBOLS)
    + " FROM cleaned c JOIN labelled l ON c.id = l.id",
    # spelling
    "spell_tokens": """
        SELECT id, unnest(l) AS word, unnest(range(len(l))) AS pos
        FROM (SELECT id, string_split(cleaned_text, ' ') AS l FROM stripped_texts)""",
    "dictionary": f"""
        SELECT word, count(*) AS freq FROM spell_tokens WHERE regexp_full_match(word, '\\p{{L}}+')
        GROUP BY word HAVING count(*) >= {MIN_COUNT}""",
    "unknown": r"""
        SELECT DISTINCT word FROM spell_tokens WHERE regexp_matches(word, '\p{L}')
          AND length(word) <= (SELECT max(length(word)) + 2 FROM dictionary)
          AND word NOT IN (SELECT word FROM dictionary)""",
    # a character that no known word holds can only go or be replaced: one sign stands for all of them
    "known_letters": "SELECT DISTINCT unnest(string_split(word, '')) AS c FROM dictionary",
    "renamed": """
        SELECT origin, string_agg(coalesce(k.c, chr(1)), '' ORDER BY i) AS word
        FROM (SELECT word AS origin, unnest(string_split(word, '')) AS c, unnest(range(length(word))) AS i FROM unknown) u
        LEFT JOIN known_letters k ON u.c = k.c GROUP BY origin""",
    "spelled": "SELECT DISTINCT word, 0 AS freq FROM renamed UNION ALL SELECT word, freq FROM dictionary",
    "letters": "SELECT c FROM known_letters UNION ALL SELECT chr(1)",
    "cuts": "SELECT word, freq, unnest(range(length(word) + 1)) AS i FROM spelled",
    "edits": """
        SELECT word, freq, word[:i] || word[i+2:] AS middle FROM cuts WHERE i < length(word)
        UNION SELECT word, freq, word[:i] || word[i+2] || word[i+1] || word[i+3:] FROM cuts WHERE i < length(word) - 1
        UNION SELECT word, freq, word[:i] || c || word[i+2:] FROM cuts, letters WHERE i < length(word)
        UNION SELECT word, freq, word[:i] || c || word[i+1:] FROM cuts, letters""",
    "reached": "SELECT middle, arg_min(word, (-freq, word)) AS candidate, max(freq) AS freq "
    "FROM edits WHERE freq > 0 GROUP BY middle",
    "spell_options": """
        SELECT e.word, 1 AS tier, d.word AS candidate, d.freq FROM edits e JOIN dictionary d ON e.middle = d.word
        WHERE e.freq = 0
        UNION ALL SELECT e.word, 2, r.candidate, r.freq FROM edits e JOIN reached r ON e.middle = r.middle
        WHERE e.freq = 0""",
    "spell_found": "SELECT word, min(tier) AS tier, arg_min(candidate, (tier, -freq, candidate)) AS candidate, "
    "arg_min(freq, (tier, -freq, candidate)) AS freq FROM spell_options GROUP BY word",
    "spell_best": "SELECT r.origin AS word, f.tier, f.candidate, f.freq FROM renamed r JOIN spell_found f ON r.word = f.word",
    "spell_fixes": "SELECT word, candidate AS correction FROM spell_best",
}


def _z(name: str) -> str:
    return f'coalesce((c."{name}" - f."a_{name}") / nullif(f."b_{name}", 0), 0.0)'


def _fit(low: str, high: str, train: str = "split = 'train'") -> str:
    names = [count_column(s) for s in SYMBOLS]
    parts = [f'{low}("{n}") AS "a_{n}", {high}("{n}") AS "b_{n}"' for n in names]
    return f"SELECT {', '.join(parts)} FROM split_counts WHERE {train}"


def _zscore(where: str, source: str = "split_counts", train: str = "split = 'train'") -> str:
    names = [count_column(s) for s in SYMBOLS]
    inner = ", ".join(f'{_z(n)} AS z{i}' for i, n in enumerate(names))
    outer = ", ".join(
        f'round({normal_cdf_sql(f"z{i}")}, 6) AS "{c}"' for i, c in enumerate(NORMALIZED)
    )
    return (
        f"SELECT id, {outer} FROM (SELECT c.id, {inner} FROM {source} c, "
        f"({_fit('avg', 'stddev_samp', train)}) f WHERE {where})"
    )


def _minmax(where: str, capped: bool) -> str:
    cells = []
    for symbol, out in zip(SYMBOLS, NORMALIZED):
        n = count_column(symbol)
        x = f'coalesce((c."{n}" - f."a_{n}") / nullif(f."b_{n}" - f."a_{n}", 0)::DOUBLE, 0.0)'
        cells.append(f'round({f"greatest(0.0, least(1.0, {x}))" if capped else x}, 6) AS "{out}"')
    return f"SELECT c.id, {', '.join(cells)} FROM split_counts c, ({_fit('min', 'max')}) f WHERE {where}"


# Normalised counts of English labelled texts, fitted on their train split.
CLEANING["english_counts"] = "SELECT s.* FROM split_counts s JOIN cleaned c ON s.id = c.id WHERE c.language = 'en'"
CLEANING["plain_normalized"] = _zscore("true", "english_counts").replace("FROM split_counts WHERE", "FROM english_counts WHERE")


def _shares(totals: str, language: str, suffix: str = "") -> str:
    total = " + ".join(EMOTIONS)
    cells = ", ".join(f"coalesce({e} / greatest({total}, 1)::DOUBLE, 0.0) AS {e}{suffix}" for e in EMOTIONS)
    return f"SELECT c.id, {cells} FROM cleaned c LEFT JOIN {totals} t ON c.id = t.id WHERE c.language = '{language}'"


def _phrase_score(lexicon: str, language: str, out: str) -> str:
    return (
        f"SELECT c.id, CAST(coalesce(s.total, 0) AS BIGINT) AS {out} FROM cleaned c LEFT JOIN "
        f"(SELECT u.id, sum(l.score) AS total FROM units u JOIN {lexicon} l ON u.unit = l.term GROUP BY u.id) s "
        f"ON c.id = s.id WHERE c.language = '{language}'"
    )


def _checksum(vec: str) -> str:
    return f"round(list_sum([CAST({vec}[i] AS DOUBLE) * i FOR i IN range(1, {DIM + 1})]), 6)"


def _training(lexicon: str) -> str:
    flags = ", ".join(f"max(CAST(emotion = '{e}' AS INT)) AS {e}" for e in EXT_EMOTIONS)
    return f"SELECT word AS phrase, {flags} FROM {lexicon} GROUP BY word"


def _macro(pairs: str, keys: str = "") -> str:
    """Per label accuracy, precision, recall and F1 averaged over the values seen."""
    k = f"{keys}, " if keys else ""
    using = f"USING ({k}label)"
    return (
        f"SELECT {k}label, avg(f) AS fscore, avg(p) AS precision, avg(r) AS recall, max(acc) AS accuracy FROM ("
        f"SELECT {k}label, p, r, acc, CASE WHEN p + r = 0 THEN 1.0 ELSE 2 * p * r / (p + r) END AS f FROM ("
        f"SELECT {k}label, v, coalesce(count(*) FILTER (q.g = v AND q.p = v) / "
        f"nullif(count(*) FILTER (q.p = v), 0)::DOUBLE, 1.0) AS p, "
        f"coalesce(count(*) FILTER (q.g = v AND q.p = v) / nullif(count(*) FILTER (q.g = v), 0)::DOUBLE, 1.0) AS r, "
        f"avg(CAST(q.g = q.p AS DOUBLE)) AS acc FROM {pairs} q JOIN ("
        f"SELECT DISTINCT {k}label, g AS v FROM {pairs} UNION SELECT DISTINCT {k}label, p FROM {pairs}) c {using} "
        f"GROUP BY {k}label, v)) GROUP BY {k}label"
    )


def _task_a(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    cells = " UNION ALL ".join(
        f"SELECT {k}'taskA_{m}' AS metric, {m} AS value FROM m" for m in ("fscore", "precision", "recall", "accuracy")
    )
    return f"(WITH m AS ({_macro('long_pairs', keys)}), m2 AS (SELECT * FROM m WHERE label = 'HS') " + cells.replace(
        "FROM m", "FROM m2"
    ) + ")"


def _task_b(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    cells = " UNION ALL ".join(
        f"SELECT {k}'taskB_{m}_' || label AS metric, {m} AS value FROM m"
        for m in ("fscore", "precision", "recall", "accuracy")
    )
    equal = " AND ".join(f"{x}_x = {x}_y" for x in LABELS)
    return (
        f"(WITH m AS ({_macro('long_pairs', keys)}) {cells} "
        f"UNION ALL SELECT {k}'taskB_fscore_macro', avg(fscore) FROM m{group} "
        f"UNION ALL SELECT {k}'taskB_emr', avg(CAST({equal} AS DOUBLE)) FROM matched{group})"
    )


def _report_position() -> str:
    from quillspark.operators.evaluate import report_order

    cases = " ".join(f"WHEN '{name}' THEN {i + 1}" for i, name in enumerate(report_order()) if name)
    return f"CASE metric {cases} END"


def _spell_output() -> str:
    return """SELECT t.id, string_agg(coalesce(f.correction, t.word), ' ' ORDER BY t.pos) AS cleaned_text
        FROM spell_tokens t LEFT JOIN spell_fixes f ON t.word = f.word GROUP BY t.id"""


_PRED_CASE = {x: f"CAST(CASE WHEN Target LIKE '%{x}%' AND Target <> 'NotHS' THEN 1 ELSE 0 END AS INT)" for x in LABELS}
_CLEAN_COLUMNS = "id, language, raw_text, cleaned_text, hashtags, user_ids, percent_capitals, " + ", ".join(
    f'"{count_column(s)}"' for s in SYMBOLS
)
_VALUES = [*NORMALIZED, *EMOTIONS]


def _feature_vectors() -> str:
    total = " + ".join(f"coalesce(e.{x}, 0)" for x in EMOTIONS)
    cells = ["c.id", "c.percent_capitals"]
    cells += [f'n."{c}"' for c in NORMALIZED]
    cells += [f"round(coalesce(e.{x}, 0) / greatest({total}, 1)::DOUBLE, 6) AS {x}" for x in EMOTIONS]
    cells += ["s.slangscore", *[f"w.{x}" for x in LABELS], "g.Target"]
    cells += [f'round(coalesce(v.d{i}, 0.0), 6) AS "Aggregate_embeddings_dim_{i}"' for i in range(DIM)]
    wide = ", ".join(f"max(value) FILTER (dim = {i}) AS d{i}" for i in range(DIM))
    return (
        f"SELECT {', '.join(cells)} FROM cleaned c JOIN tweets w ON c.id = w.id JOIN targets g ON c.id = g.id "
        f"JOIN plain_normalized n ON c.id = n.id LEFT JOIN emotion_totals e ON c.id = e.id "
        f"LEFT JOIN (SELECT id, {wide} FROM components GROUP BY id) v ON c.id = v.id "
        f"JOIN ({_phrase_score('kept_slang', 'en', 'slangscore')}) s ON c.id = s.id WHERE c.language = 'en'"
    )


def _queries() -> dict[str, str]:
    out = {
        "load_splits": "SELECT id, text, HS, TR, AG, language, split FROM tweets WHERE language IN ('en', 'es')",
        "export_gold": "SELECT c.id, c.cleaned_text, t.HS, t.TR, t.AG FROM cleaned c JOIN tweets t ON c.id = t.id "
        "WHERE c.language = 'en'",
        "export_pred_a": "SELECT id, HS AS HS_prediction FROM predicted",
        "export_pred_b": "SELECT id, HS, TR, AG FROM predicted",
        "snapshot_roundtrip": 'SELECT split, count(*) AS n, CAST(sum("!_count") AS BIGINT) AS bangs '
        "FROM english_counts GROUP BY split",
        "tokenize_ws": "SELECT id, t, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS n FROM squashed",
        "remove_urls": f"SELECT id, {_drop('t', 'http')} AS t FROM squashed",
        "hashtags": f"SELECT id, {_list('t', '#')} AS tags, {_drop('t', '#')} AS t FROM squashed",
        "usernames": f"SELECT id, {_list('t', '@')} AS users, {_users('t')} AS t FROM squashed",
        "symbol_counts": f"SELECT id, {_COUNTS}, {_strip_symbols('t')} AS t FROM squashed",
        "capital_share": f"SELECT id, {_capitals('t')} AS percent_capitals, lower(t) AS t FROM squashed",
        "emoji_names": f"SELECT id, lower({_emoji('t')}) AS t FROM squashed",
        "tokenize_words": f"SELECT id, len(l) AS n, array_to_string(l, ' ') AS tokens FROM "
        f"(SELECT id, regexp_extract_all(t, '{TOKEN}') AS l FROM squashed)",
        "clean_en": f"SELECT {_CLEAN_COLUMNS} FROM cleaned WHERE language = 'en'",
        "clean_es": f"SELECT {_CLEAN_COLUMNS} FROM cleaned WHERE language = 'es'",
        "token_length_hist": "SELECT tokens, count(*) AS n, max(max(tokens)) OVER () AS longest FROM "
        "(SELECT CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS tokens FROM squashed) "
        "GROUP BY tokens",
        "head_rows": "SELECT id, language, HS, TR, AG FROM tweets ORDER BY id LIMIT 5",
        "spell_candidates": "SELECT word, tier, candidate, freq FROM spell_best",
        "spell_correct": _spell_output(),
        "target_encode": "SELECT id, Target FROM targets",
        "target_decode": "SELECT id, "
        + ", ".join(f"{_PRED_CASE[x]} AS {x}_prediction" for x in LABELS)
        + " FROM targets",
        "target_code": "SELECT id, text AS body, CASE WHEN HS = 0 THEN '0' ELSE CAST(1 + TR + 2 * AG AS VARCHAR) END "
        "AS target FROM tweets",
        "class_counts": "SELECT Target, count(*) AS n FROM targets GROUP BY Target",
        "class_deficit": "SELECT Target, count(*) AS n, max(count(*)) OVER () - count(*) AS deficit "
        "FROM targets GROUP BY Target",
        "class_balance_support": "SELECT Target, max(count(*)) OVER () AS n, 0 AS unmatched FROM targets GROUP BY Target",
        "class_weights": "SELECT Target, (SELECT count(*) FROM targets) / "
        "((SELECT count(DISTINCT Target) FROM targets) * count(*))::DOUBLE AS weight FROM targets GROUP BY Target",
        "lexicon_last_wins": "SELECT term, score FROM last_slang",
        "stopword_anti": "SELECT term, score FROM kept_slang",
        "polarity_resolve": "SELECT term, score FROM polarity_terms",
        "lexicon_multimap": "SELECT word, array_to_string(list_sort(list(DISTINCT en_word)), ' ') AS translations, "
        "array_to_string(list_sort(list(DISTINCT emotion)), ' ') AS emotions FROM emotions_es GROUP BY word",
        "slang_score": _phrase_score("kept_slang", "en", "slangscore"),
        "polarity_score": _phrase_score("polarity_terms", "es", "sent_score"),
        "emotion_counts": "SELECT c.id, "
        + ", ".join(f"coalesce(t.{e}, 0) AS {e}" for e in EMOTIONS)
        + " FROM cleaned c LEFT JOIN emotion_totals t ON c.id = t.id WHERE c.language = 'en'",
        "emotion_shares": _shares("emotion_totals", "en"),
        "emotion_shares_es": _shares("emotion_totals_es", "es", "_esp"),
        "vector_parse": f"SELECT word, len(vec) AS dim, {_checksum('vec')} AS checksum FROM vectors",
        "glove_lookup": f"SELECT p.id, p.pos, p.word, {_checksum('v.vec')} AS checksum "
        "FROM placed p JOIN vectors v ON p.word = v.word",
        "glove_mean": "SELECT c.id, d.dim, round(coalesce(m.value, 0.0), 6) AS value FROM cleaned c "
        f"CROSS JOIN (SELECT unnest(range({DIM})) AS dim) d LEFT JOIN components m ON c.id = m.id AND d.dim = m.dim "
        "WHERE c.language = 'en'",
        "embedding_expand": "SELECT vec_id, label, "
        + ", ".join(f"embedding[{i + 1}] AS embedding_dim_{i}" for i in range(DIM))
        + " FROM embeddings",
        "doc_embedding_join": "SELECT p.id, p.language, coalesce(len(e.embedding), -1) AS dim, "
        "CAST(e.embedding[1] AS DOUBLE) AS first FROM posts p LEFT JOIN embeddings e ON p.id = e.vec_id",
        "translation_join": "SELECT p.id, p.text, coalesce(t.translated_text, '') AS translated_text "
        "FROM posts p LEFT JOIN translations t ON p.id = t.id WHERE p.language = 'es'",
        "ext_training_set": f"SELECT v.word, {', '.join(EXT_EMOTIONS)}, {_checksum('v.vec')} AS checksum "
        f"FROM ({_training('emotions')}) l JOIN vectors v ON l.phrase = v.word",
        "ext_training_set_phrases": f"SELECT v.word, {', '.join(EXT_EMOTIONS)}, {_checksum('v.vec')} AS checksum "
        f"FROM (SELECT *, unnest(string_split(phrase, ' ')) AS piece FROM ({_training('phrase_emotions')})) l "
        "JOIN vectors v ON l.piece = v.word",
        "norm_minmax": _minmax("c.split = 'train'", False),
        "norm_minmax_apply": _minmax("c.split <> 'train'", True),
        "norm_zscore": _zscore("c.split = 'train'"),
        "norm_zscore_apply": _zscore("c.split <> 'train'"),
        "feature_vectors": _feature_vectors(),
        "eval_task_a": f"SELECT metric, value FROM {_task_a()}",
        "eval_task_b": f"SELECT metric, value FROM {_task_b()}",
        "eval_checks": "SELECT g AS gold_rows, p AS pred_rows, j AS joined_rows, g = p AS same_length, "
        "g = j AS same_ids FROM (SELECT (SELECT count(*) FROM tweets) AS g, (SELECT count(*) FROM predicted) AS p, "
        "(SELECT count(*) FROM matched) AS j)",
        "eval_bad_labels": "SELECT DISTINCT 'HS' AS label, HS + TR AS value FROM predicted "
        "WHERE HS + TR NOT IN (SELECT HS FROM tweets)",
        "eval_report": f"SELECT {_report_position()} AS line_no, metric || ': ' || printf('%.6f', value) AS line "
        f"FROM (SELECT * FROM {_task_a()} UNION ALL SELECT * FROM {_task_b()}) UNION ALL SELECT 5, ''",
        "eval_by_file": "SELECT language, 'a' AS task, metric, round(value, 6) AS value FROM "
        f"{_task_a('language')} WHERE language IN ('en', 'es') UNION ALL "
        "SELECT language, 'b', metric, round(value, 6) FROM "
        f"{_task_b('language')} WHERE language IN ('en', 'es')",
    }
    counts = " UNION ALL ".join(
        f"SELECT '{x}' AS label, {x} AS v, count(*) AS n FROM tweets WHERE split = 'train' GROUP BY {x}" for x in LABELS
    )
    best = ", ".join(f"max(v) FILTER (label = '{x}') AS {x}" for x in LABELS)
    modes = (
        f"SELECT {best} FROM (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY n DESC, v) AS k "
        f"FROM ({counts})) WHERE k = 1"
    )
    out["baseline_mode"] = modes
    out["baseline_predict"] = "SELECT t.id, " + ", ".join(
        f"m.{x} AS {x}_prediction" for x in LABELS
    ) + f" FROM tweets t, ({modes}) m"
    return out


def oracle_queries() -> dict[str, str]:
    out = {name: with_clause(text, "check", CLEANING) for name, text in _queries().items()}
    spanish = {**CLEANING, "stripped_texts": CLEANING["stripped_texts"].replace("'en'", "'es'")}
    for name, text in (("spell_candidates_es", "SELECT * FROM spell_best"), ("spell_correct_es", _spell_output())):
        out[name] = with_clause(text, "check", spanish)
    return out


__all__ = ["CLASSES", "PLAIN_FEATURES", "oracle_queries"]
