"""Byte-level BPE with the tiktoken library and a local rank file.

Texts over ``LONG`` characters are cut before encoding, only at places where the pre-splitting pattern must begin a
new match whatever stands around: between a character that isn't white space and a following space or line feed.
What still has no such place for ``LONG`` characters is matched piece by piece and each match is encoded alone, as
the library does itself, without its recursion over long runs of white space. Decoding joins the ids' raw bytes.

Null and empty texts give no tokens; repeated rows stay rows of their own; no row depends on another.
"""

from __future__ import annotations

import base64
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquest.llm import common

LONG = 20_000
#: Unicode's white space, as the library's engine has it; Python's own class adds the separators 1C to 1F.
SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


@functools.lru_cache(4)
def encoding(rank_file: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(rank_file), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(rank_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(1)
def _matcher():
    import public_tokenizers
    import regex

    pattern = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    return regex.compile(pattern, regex.V0)


def safe_cuts(text: str, every: int = LONG) -> list[str]:
    """Parts of about ``every`` characters that encode one by one as they do together; a part is longer if it has no safe place."""
    parts, at = [], 0
    while len(text) - at > every:
        cut = at + every
        while True:
            found = [x for x in (text.find(" ", cut), text.find("\n", cut)) if x >= 0]
            cut = min(found, default=len(text))
            if cut == len(text) or not text[cut - 1].isspace():
                break
            cut += 1
        parts.append(text[at:cut])
        at = cut
    return [*parts, text[at:]]


def encode(enc, text: str, every: int = LONG) -> list[int]:
    if len(text) <= every:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_cuts(text, every):
        if len(part) <= 2 * every:
            ids += enc.encode_ordinary(part)
        else:
            for m in _matcher().finditer(part):
                ids += enc._encode_single_piece(m[0])
    return ids


def encode_documents(docs: DataFrame, rank_file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """doc_id, ids (array of int), decoded (binary): the ids of every text and the bytes they stand for."""

    def make():
        enc = encoding(rank_file)

        def row(doc_id, text):
            ids = encode(enc, text)
            return doc_id, ids, enc.decode_bytes(ids)

        return row

    return common.row_map(common.keyed_text(docs), make, "doc_id long, ids array<int>, decoded binary")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_documents(common.documents(spark, sf_dir))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
ORACLES: dict[str, str] = {}
