"""Operators that take each row by itself: media, BPE, and the secret scan."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from folioquest.llm import bpe, media, packing, secrets
from tests.llm.conftest import extras_unchanged, words

KINDS = ((secrets.BASE[0].pattern, 2, 8, "assign"), (secrets.BASE[1].pattern, 0, 16, "access"), (secrets.BASE[2].pattern, 0, 32, "hex"))


def brute_spans(text):
    found = []
    for k, (pattern, group, least, kind) in enumerate(KINDS):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_secrets_base_spans(spark, docs, rows, folder):
    got = sorted((r["doc_id"], r["base_sha256"]) for r in secrets.op1_secret_scan(spark, folder).collect())
    assert got == sorted((r[0], hashlib.sha256(brute_spans(r[1] or "").encode()).hexdigest()) for r in rows)


@pytest.mark.parametrize("text", ["password: token: abcdefgh1234", "😀 é token=abcdefgh", "PassWord='12345678' API_KEY:\"x\"", "f" * 31 + " " + "f" * 32, "AKIA" + "B" * 11 + " AKIA" + "B" * 12, "secret==a=b=c=d=e", ""])
def test_secret_offsets(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secrets.scan(df, rules=secrets.BASE).first()["findings"]
    assert ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in found) == brute_spans(text)


def test_secret_ledger_scans_only_unseen(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([(1, "token = abcdefgh1"), (2, "token = abcdefgh1"), (3, None)], "doc_id long, text string")
    assert [len(r["findings"]) for r in secrets.scan(first, ledger, rules=secrets.BASE).orderBy("path").collect()] == [1, 1, 0]
    pairs = lambda: spark.read.parquet(*[f"{ledger}/scanned/{b}" for b in secrets.batches(spark, ledger)]).selectExpr("sum(size(rules))").first()[0]
    assert pairs() == 2 * 3
    # the same table again: nothing to scan, the same findings
    assert [len(r["findings"]) for r in secrets.scan(first, ledger, rules=secrets.BASE).orderBy("path").collect()] == [1, 1, 0]
    assert pairs() == 2 * 3
    more = first.unionAll(spark.createDataFrame([(4, "x " + "ab12" * 8)], "doc_id long, text string"))
    rules = (*secrets.BASE[:2], secrets.Rule("hex", "[0-9a-f]+", 0, 32, version=2))
    assert [len(r["findings"]) for r in secrets.scan(more, ledger, rules=rules).orderBy("path").collect()] == [1, 1, 0, 1]
    # two known blobs by the new rule, one new blob by all three
    assert pairs() == 6 + 2 + 3
    assert secrets.redact(first, secrets.BASE, ledger=ledger).where("doc_id < 3 and text <> '[SECRET]'").isEmpty()
    assert pairs() == 6 + 2 + 3


def test_a_batch_that_broke_off_does_not_count(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, "token = abcdefgh1")], "doc_id long, text string")
    assert len(secrets.scan(docs, ledger).first()["findings"]) == 1
    (batch,) = secrets.batches(spark, ledger)
    (tmp_path / "ledger" / "scanned" / batch / "_SUCCESS").unlink()
    assert secrets.batches(spark, ledger) == [] and len(secrets.scan(docs, ledger).first()["findings"]) == 1


def test_secret_plan_is_native(spark, docs):
    plan = secrets.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redact(spark):
    df = spark.createDataFrame([(1, "a token = abcdefgh1 b " + "0f" * 20 + " c", 7), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact(df).collect()}
    assert out == {1: ("a [SECRET] b [SECRET] c", len("a [SECRET] b [SECRET] c")), 2: ("clean", 5), 3: (None, None)}


def test_row_operators_take_empty_and_clashing_tables(empty, clashing):
    for f in (secrets.scan, media.media_columns, bpe.encode_documents):
        assert f(empty).count() == 0
        assert f(clashing).count() == 13
    out = secrets.redact(clashing)
    assert out.columns == clashing.columns and extras_unchanged(out.collect())


def test_redact_long_texts_with_many_secrets(spark):
    rng = random.Random(2)
    parts = [rng.choice(["é", "😀 ", "word "]) * rng.randrange(0, 900) + f" token={'a' * 8}{k} " for k in range(300)]
    text = "".join(parts) + "end"
    for t in (text, "token=" + "b" * 9, "token=" + "b" * 9 + "x" * 5000, "x" * 4095 + " token=" + "b" * 9):
        out = secrets.redact(spark.createDataFrame([(1, t)], "doc_id long, text string"), secrets.BASE).first()["text"]
        assert out == re.sub(r"token=[a-z0-9]{8,}", "[SECRET]", t)


def test_patterns_stay_fast_on_long_runs(spark):
    long = "a" * 300_000 + " x://y:z@ eyJ" + "eyJ" * 50_000 + ". " + "password" * 20_000
    began = time.time()
    found = secrets.scan(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()["findings"]
    assert time.time() - began < 60 and any(x["kind"] == "login" for x in found)


@pytest.mark.parametrize("operator", [media.media_columns, bpe.encode_documents, packing.pack])
def test_row_operators_take_very_long_texts(spark, operator):
    text = words(random.Random(4), 200_000, 9000)
    assert operator(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).count() >= 2


def test_media_round_trip(spark, folder, rows):
    got = sorted(media.op2_media_columns(spark, folder).collect())
    want = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        padded = data + b"\xff" * (-len(data) % 576 or (576 if not data else 0))
        want.append((doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])))
    assert [tuple(r)[:5] for r in got] == sorted(want)


def test_netpbm_kinds():
    assert media.decode(b"P1\n# note\n3 1\n1 0 1\n")[:, :, 0].tolist() == [[0, 255, 0]]
    assert media.decode(b"P4\n3 1\n\xa0")[:, :, 0].tolist() == [[0, 255, 0]]
    assert media.decode(b"P2 2 1 9 4 5")[:, :, 0].tolist() == [[4, 5]]
    assert media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P5 1 2 65535\n\x01\x00\x00\x02")[:, :, 0].tolist() == [[256], [2]]
    with pytest.raises(ValueError):
        media.decode(b"PNG")


def test_bmp_round_trip_and_resize():
    pixels = np.random.default_rng(1).integers(0, 256, (5, 7, 3), np.uint8)
    assert (media.decode(media.encode_bmp(pixels)) == pixels).all() and (media.decode(media.encode_ppm(pixels)) == pixels).all()
    gray = pixels[:, :, 0].astype(float)
    fine = np.kron(gray, np.ones((8, 9)))  # cells of a 40 x 63 grid
    assert np.allclose(media.area_resize(gray, 8, 9), fine.reshape(8, 5, 9, 7).mean(axis=(1, 3)))


def test_bpe_is_the_library(spark, folder, rows):
    enc = bpe.encoding("byte_bpe_multi_50k.tiktoken")
    got = sorted(bpe.op3_byte_bpe(spark, folder).collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = enc.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert [tuple(r) for r in got] == sorted(want)


def test_bpe_cuts_change_nothing():
    rng, enc = random.Random(3), bpe.encoding("byte_bpe_multi_50k.tiktoken")
    signs = ["a", "B", "é", "漢", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "'s", "'", "9", "!", "😀"]
    for _ in range(200):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(200)))
        for every in (3, 11, 50):
            assert bpe.encode(enc, text, every) == enc.encode_ordinary(text)
    assert bpe.encode(enc, " " * 100_000 + "x") == enc.encode_ordinary(" " * 100_000 + "x")
