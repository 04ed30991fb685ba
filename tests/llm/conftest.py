import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long"


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows and clashing extra columns."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta#", "straße", "你好", "x", "42", "ÉTÉ", "of", "the", "idiot"]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    texts = [None, "", " \n\t", "one", "two words", passages[0], passages[0], passages[0] + " tail", "head. " + passages[1] + "\n" + passages[2], "a" * 350, "ab " * 120]
    texts += ["\n".join([rng.choice(passages), "Boilerplate line", rng.choice(passages)]) for _ in range(12)]
    texts.append(" ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(20_000)))
    rows = [(k, t, "en", None if k % 7 == 3 else f"src{k % 6}", None if t is None else len(t), 0.5, None) for k, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, passages[3], None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
