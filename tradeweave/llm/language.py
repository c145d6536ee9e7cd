"""Language identification by unigram pieces, summed over all segmentations.

A text's probability in a language is the product over its words, and a word's is the sum over all ways to cut it
into pieces of a fixed public vocabulary of the product of the pieces' probabilities: the forward algorithm. Piece
probabilities are learned per language by the matching expectation step (forward-backward over the words of the
learning rows), from a start that favours the vocabulary's early, frequent pieces in the same way for all languages.

Words are lower-cased and cut at white space. Lattices of many distinct words are built at once by walking the
vocabulary's trie over arrays, and their recursions run over numpy arrays. Words whose products come near the least number,
and all words of more than SHORT characters, are summed in logarithms; long words go in stretches of STRETCH starts that
hand the last sums on, so that segmentations across a stretch's end count like all others and memory stays bounded. Each
worker remembers a bounded number of words.

Defined results: a null text or one without a letter is `und` with score 0; rows with a null language are not learned
from; with nothing to learn from every text is `und`; ties go to the language that sorts first; repeated rows get the
same answer; input columns with the names of results are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.text import add_columns, apart, together

SHORT = 48  # longest word, with its mark, that is tried with plain products
STRETCH = 512  # starts of long words whose lattice is held at a time
LONG_CELLS = 1 << 21  # characters of long words that go together
HELD_WORDS = 1_000_000  # distinct words a worker counts or remembers at a time
HELD_BYTES = 64 << 20  # of their log-probabilities, for many languages
CHUNK_CHARS = 1_000_000  # characters of texts that are split into words at a time
SMOOTHING = 0.05  # added to every piece's expected count
UNKNOWN = 1e-7  # probability of a character that is no piece
_SCALE = 64.0  # per character, keeps products of probabilities in range
_LEAST = 1e-150  # smaller sums are taken in logarithms; what products lose in SHORT characters is below 1e-200
_COUNT_PARTS = 1 << 16  # expected counts are summed as whole numbers of these parts


class Vocabulary:
    """Ids of the ordinary pieces of a SentencePiece model and of all their prefixes."""

    _loaded: dict[str, "Vocabulary"] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ordinary = [i for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids: dict[str, int] = {}
        for i in ordinary:
            self.ids.setdefault(model.id_to_piece(i), len(self.ids))
        self.unknown = len(self.ids)
        self.size = self.unknown + 1
        if self.size >= 1 << 16:
            raise ValueError("more pieces than a lattice can hold")
        self._grow_trie()

    def _grow_trie(self) -> None:
        """Children by (node, character) in one sorted array, and the piece that ends at each node (-1 if none)."""
        nodes, children = {"": 0}, {}
        for piece in self.ids:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    children[nodes[piece[:n - 1]] << 21 | ord(piece[n - 1])] = nodes[piece[:n]]
        self.longest = max(map(len, self.ids))
        self._keys = np.array(sorted(children), np.int64)
        self._child = np.array([children[k] for k in self._keys.tolist()], np.int64)
        self._ends = np.full(len(nodes), -1, np.int64)
        self._ends[[nodes[piece] for piece in self.ids]] = list(self.ids.values())
        roots = self._keys < 1 << 21
        self._first = np.full(1 << 21, -1, np.int32)
        self._first[self._keys[roots]] = self._child[roots]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def start(self) -> np.ndarray:
        """Start of learning: pieces by their place in the vocabulary, the same for all languages."""
        p = 1.0 / (np.arange(self.size) + 50.0)
        p[self.unknown] = 0
        p /= p.sum()
        p[self.unknown] = UNKNOWN
        return p

    def lattice(self, texts: list[str], stretch: int | None = None) -> "Lattice":
        """All pieces that occur in the texts (with `stretch` only those that start before it), ordered by word and start."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(texts)), lengths)
        start = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(lengths, lengths) - start
        at = np.arange(len(codes)) if stretch is None else np.flatnonzero(start < stretch)
        node = self._first[codes[at]].astype(np.int64)
        single = np.where(node >= 0, self._ends[node], -1)
        places, pieces, sizes = [at], [np.where(single >= 0, single, self.unknown)], [np.ones(len(at), np.int64)]
        at, node = at[node >= 0], node[node >= 0]
        for size in range(2, self.longest + 1):
            on = left[at] >= size
            at, node = at[on], node[on]
            if not len(at):
                break
            key = node << 21 | codes[at + (size - 1)]
            found = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            on = self._keys[found] == key
            at, node = at[on], self._child[found[on]]
            piece = self._ends[node]
            on = piece >= 0
            places.append(at[on])
            pieces.append(piece[on])
            sizes.append(np.full(len(places[-1]), size, np.int64))
        place, piece, size = np.concatenate(places), np.concatenate(pieces), np.concatenate(sizes)
        order = np.argsort(place, kind="stable")
        place, piece, size = place[order], piece[order], size[order]
        return Lattice(word[place], start[place], start[place] + size, piece, lengths)

    def long_totals(self, texts: list[str], log_p: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all segmentations of long words, array (word, language), stretch by stretch."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        out = np.empty((len(texts), log_p.shape[1]))
        carried = np.full((self.longest + 1, len(texts), log_p.shape[1]), -np.inf)  # sums at a stretch's start and beyond
        carried[0] = 0
        open_words = np.arange(len(texts))
        for begin in range(0, int(lengths.max(initial=0)), STRETCH):
            parts = [texts[w][begin:begin + STRETCH + self.longest] for w in open_words]
            sums = np.full((STRETCH + self.longest + 1, len(parts), log_p.shape[1]), -np.inf)
            sums[:self.longest + 1] = carried
            self.lattice(parts, STRETCH).push(sums, log_p)
            rest = lengths[open_words] - begin
            done = rest <= STRETCH
            out[open_words[done]] = sums[rest[done], np.flatnonzero(done)]
            carried = sums[STRETCH:, ~done]
            open_words = open_words[~done]
        return out

    def long_expected(self, texts: list[str], log_p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in long words that occur counts[w] times: forward and backward sums in logarithms,
        held for whole words, over lattices of a stretch. `log_p` is one column."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        most = int(lengths.max(initial=0))
        forward = np.full((most + self.longest + 1, len(texts), 1), -np.inf)
        forward[0] = 0
        back = np.full_like(forward, -np.inf)
        back[lengths, np.arange(len(texts))] = 0
        uses = np.zeros(len(log_p))
        begins = range(0, most, STRETCH)

        def stretch(begin: int) -> Lattice:
            return self.lattice([t[begin:begin + STRETCH + self.longest] for t in texts], STRETCH)

        for begin in begins:
            stretch(begin).push(forward[begin:], log_p)
        totals = forward[lengths, np.arange(len(texts)), 0]
        for begin in reversed(begins):
            lattice, later = stretch(begin), back[begin:]
            lattice.pull(later, log_p)
            used = np.exp(forward[begin:][lattice.start, lattice.word, 0] + log_p[lattice.piece, 0]
                          + later[lattice.end, lattice.word, 0] - totals[lattice.word])
            uses += np.bincount(lattice.piece, used * counts[lattice.word], len(log_p))
        return uses


class Lattice:
    """Pieces (word, start, end, piece) of many words, walked by end for forward and by start for backward sums."""

    def __init__(self, word, start, end, piece, lengths):
        self.word, self.start, self.end, self.piece, self.lengths = word, start, end, piece, lengths

    @staticmethod
    def _steps(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(key.astype(np.uint16), kind="stable")  # starts and ends are below 2^16: a radix sort
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows):
                yield int(key[rows[0]]), rows

    def _weights(self, p: np.ndarray) -> np.ndarray:
        return p[self.piece] * (_SCALE ** (self.end - self.start))[:, None]

    def _add(self, into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        words = self.word[rows]  # ascending: the lattice is built word by word
        firsts = np.flatnonzero(np.r_[True, np.diff(words) > 0])
        into[words[firsts]] += np.add.reduceat(values, firsts, axis=0)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Scaled sums over segmentations of the first e characters: array (end, word, language)."""
        sums = np.zeros((int(self.lengths.max(initial=0)) + 1, len(self.lengths), p.shape[1]))
        sums[0] = 1
        weights = self._weights(p)
        for e, rows in self._steps(self.end):
            self._add(sums[e], rows, sums[self.start[rows], self.word[rows]] * weights[rows])
        return sums

    def totals(self, sums: np.ndarray) -> np.ndarray:
        return sums[self.lengths, np.arange(len(self.lengths))]

    def log_probabilities(self, p: np.ndarray) -> np.ndarray:
        """Array (word, language)."""
        totals = self.totals(self.forward(p))
        low = (totals < _LEAST).any(axis=1)
        out = np.log(np.where(low[:, None], 1.0, totals)) - (self.lengths * np.log(_SCALE))[:, None]
        if low.any():
            own = low[self.word]
            part = Lattice((np.cumsum(low) - 1)[self.word[own]], self.start[own], self.end[own], self.piece[own],
                           self.lengths[low])
            out[low] = part.totals(part.log_forward(np.log(p)))
        return out

    def log_forward(self, log_p: np.ndarray) -> np.ndarray:
        """Logarithms of the forward sums, for any probabilities: array (end, word, language)."""
        sums = np.full((int(self.lengths.max(initial=0)) + 1, len(self.lengths), log_p.shape[1]), -np.inf)
        sums[0] = 0
        for e, rows in self._steps(self.end):
            words = self.word[rows]
            firsts = np.flatnonzero(np.r_[True, np.diff(words) > 0])
            values = sums[self.start[rows], words] + log_p[self.piece[rows]]
            top = np.maximum.reduceat(values, firsts, axis=0)
            spread = np.exp(values - np.repeat(top, np.diff(np.r_[firsts, len(rows)]), axis=0))
            sums[e, words[firsts]] = top + np.log(np.add.reduceat(spread, firsts, axis=0))
        return sums

    def push(self, sums: np.ndarray, log_p: np.ndarray) -> None:
        """Adds the pieces' logarithms to sums (end, word, language), start by start; a word has one piece per start and end."""
        for s, rows in self._steps(self.start):
            words, ends = self.word[rows], self.end[rows]
            sums[ends, words] = np.logaddexp(sums[ends, words], sums[s, words] + log_p[self.piece[rows]])

    def pull(self, back: np.ndarray, log_p: np.ndarray) -> None:
        """Fills the backward sums (start, word, 1) from the last start to the first."""
        for s, rows in reversed(list(self._steps(self.start))):
            words = self.word[rows]
            firsts = np.flatnonzero(np.r_[True, np.diff(words) > 0])
            values = back[self.end[rows], words] + log_p[self.piece[rows]]
            back[s, words[firsts]] = np.logaddexp.reduceat(values, firsts, axis=0)

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece when word w occurs counts[w] times; p is one column."""
        sums, back = self.forward(p), np.zeros((int(self.lengths.max(initial=0)) + 1, len(self.lengths), 1))
        weights = self._weights(p)
        back[self.lengths, np.arange(len(self.lengths))] = 1
        for s, rows in reversed(list(self._steps(self.start))):
            self._add(back[s], rows, back[self.end[rows], self.word[rows]] * weights[rows])
        used = sums[self.start, self.word, 0] * weights[:, 0] * back[self.end, self.word, 0]
        used *= (counts / self.totals(sums)[:, 0])[self.word]
        return np.bincount(self.piece, used, len(p))


def marked(word: str) -> str:
    return "▁" + word


def groups(words: list[str]) -> Iterator[tuple[bool, list[int]]]:
    """(long, places of words) that go together: 20,000 short words, or long ones of like length up to LONG_CELLS characters."""
    short = [k for k, w in enumerate(words) if len(w) < SHORT]
    for at in range(0, len(short), 20_000):
        yield False, short[at:at + 20_000]
    held: list[int] = []
    for k in sorted((k for k, w in enumerate(words) if len(w) >= SHORT), key=lambda k: len(words[k])):
        if held and (len(held) + 1) * (len(words[k]) + 1) > LONG_CELLS:
            yield True, held
            held = []
        held.append(k)
    if held:
        yield True, held


def chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def expected_counts(docs: DataFrame, text: str, lang: str, path: str) -> DataFrame:
    """(lang, piece, uses): expected uses of pieces over all rows with text and language, summed in whole parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary.load(path)
        p = vocabulary.start()[:, None]
        held: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}

        def settle() -> None:
            for language, words in held.items():
                total = sums.setdefault(language, np.zeros(vocabulary.size))
                names, uses = list(words), np.fromiter(words.values(), float, len(words))
                for long, at in groups(names):
                    own = [marked(names[k]) for k in at]
                    total += vocabulary.long_expected(own, np.log(p), uses[at]) if long else \
                        vocabulary.lattice(own).expected(p, uses[at])
            held.clear()

        for batch in batches:
            for language, own in batch.groupby("l", sort=False)["t"]:
                for part in chunks(list(own)):
                    held.setdefault(language, Counter()).update(" ".join(part).lower().split())
                    if sum(map(len, held.values())) > HELD_WORDS:
                        settle()
        settle()
        for language, total in sums.items():
            whole = np.round(total * _COUNT_PARTS).astype(np.int64)
            used = np.flatnonzero(whole)
            yield pd.DataFrame({"lang": language, "piece": used.astype(np.int32), "uses": whole[used]})

    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).filter(
        F.col("t").isNotNull() & F.col("l").isNotNull())
    return rows.mapInPandas(run, "lang string, piece int, uses long").groupBy("lang", "piece").agg(
        F.sum("uses").alias("uses"))


def learn(docs: DataFrame, text: str, lang: str, path: str) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities, array (piece, language): one row per piece of the fixed vocabulary."""
    found = expected_counts(docs, text, lang, path).toPandas()  # at most vocabulary times languages
    vocabulary = Vocabulary.load(path)
    languages = sorted(found["lang"].unique())
    counts = np.full((vocabulary.size, len(languages)), SMOOTHING)
    column = found["lang"].map({language: i for i, language in enumerate(languages)}).to_numpy(np.int64)
    counts[found["piece"].to_numpy(np.int64), column] += found["uses"].to_numpy() / _COUNT_PARTS
    counts[vocabulary.unknown] = 0
    p = counts / counts.sum(0)
    p[vocabulary.unknown] = UNKNOWN
    return languages, p


class Scorer:
    """Sums of word log-probabilities of texts. The first words met are remembered, up to HELD_WORDS or HELD_BYTES, later ones for a chunk of texts."""

    def __init__(self, path: str, p: np.ndarray):
        self.vocabulary, self.p = Vocabulary.load(path), p
        self.rows: dict[str, int] = {}
        self.table = np.empty((min(HELD_WORDS, HELD_BYTES // max(1, 8 * p.shape[1])), p.shape[1]))

    def _log_probabilities(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.p.shape[1]))
        for long, at in groups(words):
            own = [marked(words[k]) for k in at]
            out[at] = self.vocabulary.long_totals(own, np.log(self.p)) if long else \
                self.vocabulary.lattice(own).log_probabilities(self.p)
        return out

    def score_many(self, texts: list[str]) -> list[np.ndarray]:
        """Sums over each text's words; words that are new in a chunk of texts are looked up together."""
        out = []
        for part in chunks(texts):
            split = [t.lower().split() for t in part]
            rows = [np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words)) for words in split]
            missing = [[words[i] for i in np.flatnonzero(at < 0)] for words, at in zip(split, rows)]
            fresh = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(missing)))}
            new = list(fresh)
            found = self._log_probabilities(new)
            for at, words in zip(rows, missing):
                sums = self.table[at[at >= 0]].sum(0)
                if words:
                    sums = sums + found[np.fromiter(map(fresh.__getitem__, words), np.int64, len(words))].sum(0)
                out.append(sums)
            first = len(self.rows)
            room = min(len(new), len(self.table) - first)
            self.table[first:first + room] = found[:room]
            self.rows.update(zip(new[:room], range(first, first + room)))
        return out


_SCORERS: dict[int, Scorer] = {}


def identify(docs: DataFrame, path: str, text: str = "text", lang: str = "lang",
             learn_from: Column | None = None) -> DataFrame:
    """`docs` with `lang_pred` and `score`, the probability of that language among the learned ones.

    `learn_from` marks the rows to learn from (all if not given); the model read from them is vocabulary times
    languages in size.
    """
    inner, at = apart(docs)
    known = inner if learn_from is None else apart(docs.filter(F.coalesce(learn_from, F.lit(False))))[0]
    languages, p = learn(known, at[text], at[lang], path)
    token = hash((path, p.tobytes()))
    source, sent = at[text], docs.sparkSession.sparkContext.broadcast(p)  # vocabulary times languages

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        if token not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[token] = Scorer(path, sent.value)
        texts = list(batch[source])
        fit = [i for i, t in enumerate(texts) if languages and t is not None and any(map(str.isalpha, t))]
        pred, score = ["und"] * len(texts), np.zeros(len(texts))
        for i, sums in zip(fit, _SCORERS[token].score_many([texts[i] for i in fit])):
            best = int(sums.argmax())
            pred[i], score[i] = languages[best], 1.0 / np.exp(sums - sums[best]).sum()
        return pd.DataFrame({"_lang_pred": pred, "_score": score})

    told = add_columns(inner, [source], "_lang_pred string, _score double", rows)
    return together(told, docs.columns, [("lang_pred", F.col("_lang_pred")), ("score", F.col("_score"))])
