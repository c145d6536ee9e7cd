"""Line-first cleaning: rules per line, failing lines go, then documents that lost too much text go.

A document is first measured as a whole (words, symbols, repeated lines and windows) and fails outright when it is
too short or repeats itself. Then every line with a word meets the line rules; lines that fail are removed and the
document is kept when enough of its words are left.

Defined results: null, empty and blank texts have no words and fail; lines are what `\\n` splits, so a text without
one is a single line; lines without a word are neither counted nor judged and stay in place; a repeated row gets the
same result each time; input columns with the names of results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tradeweave.llm.text import add_columns, apart, gram_hashes, mixed, together
from pyspark.sql import functions as F

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# Phrases of page furniture that carry no content. Licence notices are not among them.
BOILERPLATE = (
    "all rights reserved", "terms of service", "terms of use", "terms and conditions", "privacy policy",
    "cookie policy", "use cookies", "uses cookies", "accept cookies", "enable javascript", "lorem ipsum",
    "subscribe to our", "sign up for our", "click here", "read more", "skip to content", "back to top",
    "powered by",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules. A share is of the line's words, or of its non-blank characters where it says so."""

    min_words: int = 10            # document: fewer words fail
    max_repeat_percent: int = 20   # document: words in repeated windows beyond this percentage fail
    max_symbol_chars: float = 0.10   # punctuation: share of characters that are symbols
    max_marked_words: float = 0.5    # punctuation: share of words that end in a run of two or more ! ? * # and the like
    min_letter_chars: float = 0.5    # punctuation: least share of characters that are letters
    min_separators: int = 3          # navigation: so many stand-alone separators, and
    max_separator_gap: float = 4.0   # ... no more than so many words to each of them
    boilerplate_words: int = 30      # boilerplate: phrases count against a line of at most so many words
    min_boilerplate: float = 0.3     # ... when they make up this share of its words
    max_lost_words: float = 0.3      # document: share of words in failed lines


_MARKED = regex.compile(rb"[!?*#%&$|<>~^=_+]{2,}$")
_SEPARATORS = {b"|", b"||", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2", b">", b">>", b"/", b"::"}
_BOILERPLATE = regex.compile(r"(?<!\w)(?:" + "|".join(map(regex.escape, BOILERPLATE)) + r")(?!\w)")
_LETTER = regex.compile(r"\p{L}")


def line_fails(line: str, found: list[bytes], rules: LineRules) -> bool:
    """Whether a line with words fails one of the rules."""
    n = len(found)
    chars = sum(len(w.decode("utf-8", "surrogatepass")) for w in found)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols > rules.max_symbol_chars * chars:
        return True
    if n >= 3 and sum(1 for w in found if _MARKED.search(w)) > rules.max_marked_words * n:
        return True
    if n >= 3 and len(_LETTER.findall(line)) < rules.min_letter_chars * chars:
        return True
    separators = sum(1 for w in found if w in _SEPARATORS)
    if separators >= rules.min_separators and n <= rules.max_separator_gap * separators:
        return True
    if n > rules.boilerplate_words:
        return False
    furniture = sum(phrase.count(" ") + 1 for phrase in _BOILERPLATE.findall(line.lower()))
    return furniture > 0 and furniture >= rules.min_boilerplate * n


def repeated_words(found: list[bytes]) -> int:
    """Words in windows of five that occur twice or more in the text, the first included."""
    n = len(found) - WINDOW + 1
    if n < 2:
        return 0
    hashed = mixed(np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64))
    grams = gram_hashes(hashed, WINDOW)
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(found) + 1, np.int64)
    edges[starts] += 1
    np.subtract.at(edges, starts + WINDOW, 1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def judge(text: str | None, rules: LineRules) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_words, cleaned text."""
    text = text or ""
    found = text.encode("utf-8", "surrogatepass").split()
    n, repeated = len(found), repeated_words(found)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    seen, duplicates, lost, kept_lines = set(), 0, 0, []
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            duplicates += line in seen
            seen.add(line)
            if line_fails(line, own, rules):
                lost += len(own)
                continue
        kept_lines.append(line)
    kept = not failed and lost <= rules.max_lost_words * n and n - lost >= rules.min_words
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), duplicates, repeated,
            failed, kept, lost, "\n".join(kept_lines))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"]


def judge_documents(docs: DataFrame, text: str = "text", rules: LineRules = LineRules(),
                    cleaned: bool = False) -> DataFrame:
    """`docs` with the measures, the verdict `kept` and, if asked for, `cleaned_text` (null for a null text).

    One pass, no shuffle; only the text leaves the JVM.
    """
    inner, at = apart(docs)
    source = at[text]

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame([judge(t, rules) for t in batch[source]], columns=[*MEASURES, "cleaned_text"])
        return out if cleaned else out.drop(columns="cleaned_text")

    schema = ", ".join(f"_{m} {'boolean' if m in ('base_failed', 'kept') else 'long'}" for m in MEASURES)
    judged = add_columns(inner, [source], schema + (", _cleaned_text string" if cleaned else ""), rows,
                         once=cleaned)
    new = [(m, F.col(f"_{m}")) for m in MEASURES]
    if cleaned:
        new.append(("cleaned_text", F.when(F.col(source).isNotNull(), F.col("_cleaned_text"))))
    return together(judged, docs.columns, new)
