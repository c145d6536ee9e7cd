"""Exact token counts of whole texts by the whole-token shortcut.

Offline, once a vocabulary file, on the driver: every vocabulary string that ends a word is proved or not to encode alone
as one token (`whole_tokens`): the normaliser leaves it as it is, the pre-tokenizer leaves it in one piece, the merges
end in one token, and no added token's string is inside. In the tasks a pre-token found among the proved ones counts one
without any merge; only the rest goes through the merges, each distinct one once per worker as long as it is remembered.

A text is cut at ASCII white space first. The vocabulary must drop white space (checked on the driver: no piece comes
from it), so no normalisation, added token, pre-token or merge reaches over a cut.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of added tokens inside a text count as the
library counts them by default, one token each; nothing is truncated. Rows are independent: repeated rows count each,
an empty table gives an empty one, and new columns replace input columns of the same name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeweave.llm.text import Memo, apart, together

REMEMBERED = 400_000  # distinct strings a worker keeps, of 64 bytes at most each
_WHITE = b" \t\n\r\x0b\x0c"


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """Strings proved to encode alone as one token, in the alphabet that the merges work on, without the end mark."""
    tok = Tokenizer.from_str(vocabulary)
    told = json.loads(vocabulary)
    end = told["model"].get("end_of_word_suffix") or ""
    added = [a["content"] for a in told["added_tokens"]]
    letters = _byte_letters()
    proved = set()
    for piece in told["model"]["vocab"]:
        if not piece.endswith(end) or len(piece) == len(end):
            continue
        inner = piece[:len(piece) - len(end)]
        try:
            plain = bytes(letters[c] for c in inner).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        cut = [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(plain)]
        if (tok.normalizer.normalize_str(plain) == plain and cut == [inner] and len(tok.model.tokenize(inner)) == 1
                and not any(a in plain for a in added)):
            proved.add(inner)
    return frozenset(proved)


def _check(vocabulary: str) -> None:
    """The cut at white space and the split at added tokens hold for this file."""
    told = json.loads(vocabulary)
    tok = Tokenizer.from_str(vocabulary)
    if tok.pre_tokenizer is None or tok.normalizer is None or told["post_processor"] is not None:
        raise ValueError("a normaliser, a pre-tokenizer and no post-processor are needed")
    for w in _WHITE.decode():
        if [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(f"a{w}b"))] != ["a", "b"]:
            raise ValueError(f"white space {w!r} does not separate")
    for a in told["added_tokens"]:
        if a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or set(a["content"].encode()) & set(_WHITE):
            raise ValueError(f"added token {a['content']!r} reaches over its own string")


class ChunkCounter:
    """Number of tokens of a string without ASCII white space."""

    def __init__(self, vocabulary: str, whole: frozenset[str]):
        self.tok = Tokenizer.from_str(vocabulary)
        self.whole = whole
        added = sorted((a["content"] for a in json.loads(vocabulary)["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.merged = Memo(lambda piece: len(self.tok.model.tokenize(piece)), REMEMBERED)
        self.chunks = Memo(self.count, REMEMBERED)

    def count(self, chunk: bytes) -> int:
        text, total = chunk.decode("utf-8", "replace"), 0
        parts = [text]
        if self.added is not None:
            parts = self.added.split(text)
            total = len(parts) - 1
        for part in parts:
            if part:
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part)):
                    total += 1 if piece in self.whole else self.merged[piece]
        return total

    def text(self, data: bytes | None) -> int:
        return sum(map(self.chunks.__getitem__, data.split())) if data else 0


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit (more than `limit` tokens).

    The vocabulary file and the proved strings, both bounded by the vocabulary, go to the tasks as a broadcast; no
    executor reads `path`. Memory of a task: one batch of texts and the remembered strings.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    _check(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, whole_tokens(vocabulary)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = ChunkCounter(*shared.value)
        for batch in batches:
            yield pa.array([counter.text(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch], pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, "long").asNondeterministic()  # evaluated once, whatever is done with the column
    inner, name = apart(docs)
    data = F.col(name[text]).cast("binary")
    counted = inner.withColumn("_bytes", F.coalesce(F.octet_length(data), F.lit(0)).cast("long")).withColumn(
        "_tokens", udf(data))
    return together(counted, docs.columns, [("n_bytes", F.col("_bytes")), ("n_tokens", F.col("_tokens")),
                                            ("over_limit", F.col("_tokens") > limit)])
