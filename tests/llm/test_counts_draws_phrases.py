"""Token counts, importance resampling and collocations against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeweave.llm import collocations as C
from tradeweave.llm import resampling as R
from tradeweave.llm.queries import tokenizer_path
from tradeweave.llm.token_counts import ChunkCounter, count_tokens, whole_tokens
from tradeweave.llm.word_slices import slices

PATH = tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "Hello  WORLD's we'll\tit'd", "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|EndOfText|>",
       "Größe ǅ İstanbul ΣΑΣ Å ﬁ é ́x a ́", "漢字かな交じり文 123 4½ ²", "x" * 3000, "😀😀!?…—", "a b c\u0085d e",
       "a\x1cb\x1fc\x00d\x0be\x0cf", "don't 'S ''s '", "​zero‍", "ÀÀ́", "한국어 각"]


def random_text(rng: random.Random) -> str:
    alphabet = "aAbé ß'sSt.,!  \n\t0１½字😀́ \x1c<|>endoftext"
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))


def test_counts_equal_the_library(spark, awkward, nothing):
    tok = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    texts = ODD + [random_text(rng) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(-1, None, "x")],
                                 "doc_id long, text string, n_tokens string").repartition(3)
    for frame in (docs, awkward):
        for row in count_tokens(frame, PATH, limit=20).collect():
            want = len(tok.encode(row["text"] or "", add_special_tokens=False).ids)
            assert row["n_tokens"] == want and row["over_limit"] == (want > 20), row["text"]
            assert row["n_bytes"] == len((row["text"] or "").encode())
    assert count_tokens(nothing, PATH, limit=1).count() == 0


def test_every_proved_string_is_one_token_and_the_shortcut_is_used():
    vocabulary = open(PATH, encoding="utf-8").read()
    tok = Tokenizer.from_str(vocabulary)
    whole = whole_tokens(vocabulary)
    assert len(whole) > 20_000
    plain = [p for p in sorted(whole) if p.isascii()]
    assert all(len(e.ids) == 1 for e in tok.encode_batch(plain, add_special_tokens=False))
    counter = ChunkCounter(vocabulary, whole)
    assert counter.text(b"the house the") == 3 and not counter.merged
    assert counter.text(b"qzxv") > 1 and list(counter.merged) == ["qzxv"]


def test_slices_lose_no_word():
    rng = random.Random(1)
    data = " ".join("".join(rng.choice("ab;") for _ in range(rng.randrange(1, 9))) for _ in range(500)).encode()
    table = bytes(0x20 if b == 0x3B else b for b in range(256))
    for size in (1, 7, 100):
        words, n = [], 0
        for part, lead in slices(data, table, 2, size=size):
            assert part[:lead] == words[len(words) - lead:]
            words += part[lead:]
            n += 1
        assert words == data.translate(table).split() and n > 1


# ---- resampling -----------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_features(text):
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % R.BUCKETS for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(docs, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text))
    for text in target:
        t.update(plain_features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + R.BUCKETS) / ((s[b] + 1) * (big_t + R.BUCKETS))))
            for b in range(R.BUCKETS)}
    out = []
    for i, text in docs:
        f = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))),
                    len(plain_words(text)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    drawn = able[:percent * len(able) // 100]
    ranks = Counter((tuple(r[:4]), k) for k, r in enumerate(drawn, 1))
    return Counter((*r[:4], None) for r in out) - Counter((*r, None) for r, _ in ranks) + Counter(
        (*r, k) for r, k in ranks)


def result(frame):
    return Counter(tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_resampling_equals_plain(spark, awkward, nothing, monkeypatch):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["Alpha", "beta", "γ", "x1", "-", "long" * 30]) for _ in range(rng.randrange(60))))
            for i in range(400)] + [(7, "beta " * 30)] * 40 + [(None, "beta " * 25)] * 30 + [(900, None), (901, "")]
    target = ["alpha x1 alpha γ", None, "beta " * 10 + "long" * 30]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    monkeypatch.setattr(R, "ROWS_PER_PART", 10)  # many parts in ranks
    for percent in (5, 40, 100):
        assert result(R.resample(frame, goal, percent)) == plain_resample(docs, target, percent)
    odd = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = R.resample(awkward, goal, 50)
    assert result(got) == plain_resample(odd, target, 50) and got.columns.count("score") == 1
    assert result(R.resample(awkward, nothing, 50)) == plain_resample(odd, [], 50)
    assert R.resample(nothing, goal).count() == 0


def test_cutoff_in_a_wider_bracket(spark, monkeypatch):
    """A sketch that misses is widened until exact counts confirm it."""
    monkeypatch.setattr(R, "SKETCH", 2)
    rows = spark.range(5000).select((100 - 90 * F.col("id") % 5000).alias("_score"))
    scores = sorted((r[0] for r in rows.collect()), reverse=True)
    for wanted in (1, 250, 4999, 5000):
        low, high, above = R._bracket(rows, wanted, 5)
        assert above == sum(high is not None and s > high for s in scores) < wanted
        assert low is None or scores[wanted - 1] >= low


@pytest.mark.parametrize("head,tail", [("a", " b"), ("", " x"), ("Größe", " " + "y" * 63), ("q", " " + "z" * 5000), ("字" * 40, " 1")])
def test_joined_crc(head, tail):
    a, b = head.encode(), tail.encode()
    got = R.joined_crc(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
    assert int(got[0]) == zlib.crc32(a + b)


# ---- collocations ---------------------------------------------------------------------------------------------------

def plain_collocations(docs, least, most):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cand.items():
        if any(100 * b >= 80 * a and q != w and any(q[i:i + len(w)] == w for i in range(len(q) - len(w) + 1))
               for (other, q), b in cand.items() if other == lang and len(q) > len(w)):
            continue
        score, cut = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]], cut))
    return sorted((lang, k, p.decode(), -a, left, right, n[lang], -s, cut) for lang, rows in out.items()
                  for k, (s, a, p, left, right, cut) in enumerate(sorted(rows)[:most], 1))


def phrases_of(frame, **settings):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]
    return sorted(tuple(r) for r in C.collocations(frame, **settings).select(*columns).collect())


def prose(rng):
    fixed = ["new york city", "once upon a time", "as well", "Ünïcode 字"]
    return "".join((rng.choice(fixed) if rng.random() < .3 else rng.choice("abcdefgh") * 2) + rng.choice([" "] * 9 + [", ", ".\n", "\t", "\x1c"])
                   for _ in range(rng.randrange(80)))


def test_collocations_equal_plain(spark, awkward, nothing):
    rng = random.Random(11)
    docs = [(rng.choice(["en", "de", None]), prose(rng)) for _ in range(150)] + [("en", "rare pair here " * 40)] * 3 + [("xx", None)]
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string").repartition(4)
    for least, most in ((5, 2000), (30, 7)):
        assert phrases_of(frame, least=least, most=most) == plain_collocations(docs, least, most)
    odd = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert phrases_of(awkward, least=3, most=50) == plain_collocations(odd, 3, 50)
    assert phrases_of(nothing, least=3) == []


def test_sample_that_misses_everything(spark, monkeypatch):
    """Border failures expand pass by pass; a bitmap that is nearly full changes nothing."""
    docs = [("en", "one two three four five. six")] * 6
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string")
    want = plain_collocations(docs, 5, 100)
    for sample in (1, 10 ** 9):
        runs = C.frequent_runs(frame, "text", "lang", "doc_id", 5, sample=sample)
        assert runs.filter("size = 4").count() == 2 and runs.filter("size = 0").first()["n"] == 36
        assert runs.count() == runs.select("phrase").distinct().count() == 6 + 4 + 3 + 2 + 1
    monkeypatch.setattr(C, "MOST_BITS", 128)
    assert phrases_of(frame, least=5, most=100) == want


def test_blocks_that_end_inside_texts_count_every_run_once(monkeypatch):
    rng = random.Random(2)
    docs = [(rng.choice(["en", "de"]), prose(rng) * 3) for _ in range(30)]
    monkeypatch.setattr(C, "BLOCK_WORDS", 50)
    monkeypatch.setattr(C, "slices", lambda *a: slices(*a, size=40))
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1].encode() for d in docs])], ["lang", "text"])
    got = Counter()
    for lang, tokens, sizes, leads in C._tokens_by_language(iter([batch]), 3):
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        new = np.arange(len(tokens)) - begin >= np.repeat(leads, sizes)
        for size, phrases, counts in C._count_block(lang, tokens, new, 4, None, None, True):
            for phrase, n in zip(phrases.to_pylist(), counts.tolist()):
                got[lang, size, phrase.decode()] += n
    want = Counter()
    for lang, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            want[lang, 0, ""] += len(w)
            want.update((lang, k, " ".join(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    assert got == want


def test_later_passes_count_the_same_from_the_places_around_new_phrases(monkeypatch):
    def bitmap(phrases):
        words = np.zeros(1 << 8, np.uint64)
        for at in C.bit_places(C.phrase_hashes(["en"] * len(phrases), phrases), np.uint64((1 << 14) - 1)):
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        return C.Bitmap(words)

    def counted(wanted, seen):
        got = Counter()
        for lang, tokens, sizes, leads in C._tokens_by_language(iter([batch]), 3):
            begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
            new = np.arange(len(tokens)) - begin >= np.repeat(leads, sizes)
            for size, phrases, counts in C._count_block(lang, tokens, new, 4, wanted, seen, False):
                for phrase, n in zip(phrases.to_pylist(), counts.tolist()):
                    got[size, phrase.decode()] += n
        return got

    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghij.") for _ in range(rng.randrange(80))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array([t.encode() for t in texts])], ["lang", "text"])
    monkeypatch.setattr(C, "slices", lambda *a: slices(*a, size=30))
    grams = [" ".join(p) for p in itertools.product("abcdefghi", repeat=2)]
    real, looked = C._around_fresh, []

    def around(*args):
        looked.append(real(*args))
        return looked[-1]

    for fresh in (["a b"], ["j"], ["a b c", "d e"], ["i j", "j", "j a"]):
        proposed = list("abcdefghi") + [g for g in rng.sample(grams, 40) if g not in fresh]
        seen, wanted = bitmap(proposed), bitmap(proposed + fresh + (["a b", "b c"] if "a b c" in fresh else []))
        monkeypatch.setattr(C, "_around_fresh", lambda ids, *rest: np.ones(len(ids), bool))
        want = counted(wanted, seen)
        monkeypatch.setattr(C, "_around_fresh", around)
        assert counted(wanted, seen) == want and want
    assert sum(map(np.sum, looked)) < sum(map(len, looked))
    looked.clear()
    assert not counted(wanted, wanted) and looked and not any(kept.any() for kept in looked)


def test_tokens_are_found_without_an_object_for_each_word(monkeypatch):
    """Arrays from the bytes of segments: the words, marks and sizes that splitting gives, whole texts and slices alike."""
    rng = random.Random(9)
    texts = ["", "  ", ".", "a", " a,,b  c\t", "ÀB\x00 字.", "x" * 100] + [prose(rng) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t.encode() for t in texts])], ["lang", "text"])
    monkeypatch.setattr(C, "slices", lambda *a: slices(*a, size=40))
    for whole in (C.WHOLE, 30):
        monkeypatch.setattr(C, "WHOLE", whole)
        want, sizes, leads = [], [], []
        for t in texts:
            data = t.encode()
            parts = [(data.translate(C._TABLE).replace(b"\xff", b" \xff ").split(), 0)] if len(data) <= whole else slices(
                data, C._TABLE, 3, b"\xff", size=40)
            for words, lead in parts if data else []:
                want += [*words, b"\xff"]
                sizes.append(len(words) + 1)
                leads.append(lead)
        (lang, tokens, told, lead), = C._tokens_by_language(iter([batch]), 3)
        ids, words = tokens.numbered()
        assert [words[i].as_py() if i else b"\xff" for i in ids.tolist()] == want and len(tokens) == len(want)
        assert told.tolist() == sizes and lead == leads and not hasattr(tokens, "latest")
    monkeypatch.setattr(C, "BLOCK_BYTES", 100)
    assert sum(len(tokens) for _, tokens, _, _ in C._tokens_by_language(iter([batch]), 3)) == len(want)
