import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: documents with columns that clash with names the operators use inside
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, block int, a binary, length long, fp long, slot int, score double, blob string, __blob string, __cuts int, __block string, `__id` long, __h string, __n string, block_ int, n string, h string, `row` string, own_id string, cuts string, trains string, fold string, positive string, bucket string, text2 string, `with.dot` string"
EXTRA = (1, b"x", 2, 3, 4, 0.5, "b", "c", 5, "d", 6, "e", "f", 7, *"ghijklmnopq")


def words(rng, n, size=40):
    return " ".join(f"w{rng.randrange(size)}{'x' * rng.randrange(3)}" for _ in range(n))


def sample_rows(seed=5):
    """Copies, near copies, shared passages, repeated rows, empty, null, blank and long texts, and secrets."""
    rng = random.Random(seed)
    passage = words(rng, 70, 4000)
    base = words(rng, 120, 4000)
    texts = [base, base, base.replace("w1", "W1", 1), base + " end", None, "", " \n\t ", "one", "Zwei wörter 漢字 😀", passage]
    texts += [words(rng, 30, 4000) + " " + passage + " " + words(rng, 20, 4000) for _ in range(6)]
    texts += [words(rng, rng.randrange(1, 200), 4000) for _ in range(12)]
    texts += ["a" * 1500, "ab " * 700, words(rng, 4000, 900), 'password = "abcd1234efgh" AKIA' + "A1" * 8 + " " + "0af9" * 10]
    texts += ["#$% a a a\nline one\nline one\nline one\n" * 3, "é" * 400]
    rows = [(k, t, ("en", "de", None)[k % 3], "hot" if k % 3 else "src1", None if t is None else len(t)) for k, t in enumerate(texts)]
    return [*rows, rows[0], rows[4], rows[10]]


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows[:12]] + [(None, "no id here", "en", "s", 10, *EXTRA)], CLASHING)


def extras_unchanged(out):
    """Whether the clashing columns of rows that came through a stage are as they went in."""
    return all(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r[5:]) == EXTRA for r in out)


@pytest.fixture
def folder(spark, rows, tmp_path):
    """A data folder with documents, labels and conversations."""
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(0, 30, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)
