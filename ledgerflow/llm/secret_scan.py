"""Secret scan: fixed patterns, and password guess costs for values in context.

Three patterns find assignments, access keys and long hexadecimal runs.  The
method adds values that stand where a credential is expected (after a
credential word, in a URL's user part, after an authorisation scheme, behind
a password option) and that would cost an attacker many guesses.  The cost is
the cheapest way to put the value together from dictionary words, dates,
repeats, keyboard walks and brute-force spans, found by dynamic programming
over its positions; an ordinary word costs a few thousand guesses, a random
string of the same length many millions.

Everything runs in one pass over the documents without a shuffle.

Defined cases: a null text is read as an empty one and has no spans; columns
not named are not read; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import functools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import common

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: The same matches as HEX with 24 or more characters, found faster.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

#: Where a credential is expected; group 1 is the value, of any length (one
#: class of characters, without going back, so matching stays linear).  The
#: words of ASSIGN also stand at the end of a longer name, as they do there; a
#: value that begins with one of them and a separator belongs to the inner word.
CONTEXTS = (
    re.compile(r"""(?ai:\b(?:pwd|pass|passphrase|passcode|credential|auth_?token|private_?key)|password|passwd|secret|token|api_?key)["']?\x20*(?:[:=]|=>|\x20is\x20)\x20*["']?(?!(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=])([^\s"'`,;<>]{6,}+)"""),
    re.compile(r"""(?ai:[a-z][a-z0-9+.-]{1,16}://[^\s/:@]++):([^\s/@]{6,}+)@"""),
    re.compile(r"""(?ai:\b(?:bearer|basic))\x20+([A-Za-z0-9+/_.~=-]{6,}+)"""),
    re.compile(r"""--(?ai:password|passwd|token|secret)[\x20=]([^\s"'`,;<>]{6,}+)"""),
)

#: Rows of a QWERTY keyboard; a walk goes along a row either way.
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: Frequent passwords that a list of words does not hold.
FREQUENT = ("password", "letmein", "welcome", "iloveyou", "admin", "monkey", "dragon", "sunshine", "princess", "football", "baseball", "master", "shadow", "superman", "trustno", "changeme", "default", "secret", "login", "guest")
#: Characters written for letters.
LOOKALIKE = str.maketrans("4@3015$78", "aaeoisstb")

#: log10 guesses from which a value in a credential context counts as secret.
MIN_LOG10_GUESSES = 9.0
#: log10 guesses of one more segment: which kinds follow each other.
SEGMENT_COST = math.log10(3)
#: Segments longer than this are put together from shorter ones.
LONGEST_SEGMENT = 32

DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")


def words_by_rank(rank_file: str, limit: int = 20_000) -> dict[str, int]:
    """Dictionary by a rule: the alphabetic tokens of three letters or more of
    a public rank file, lower-cased, in rank order, behind FREQUENT."""
    ranked = {w: k for k, w in enumerate(FREQUENT, 1)}
    with open(rank_file, "rb") as f:
        for line in f:
            word = base64.b64decode(line.split()[0]).decode("utf-8", "ignore").strip().lower()
            if len(word) > 2 and word.isascii() and word.isalpha() and word not in ranked:
                ranked[word] = len(ranked) + 1
                if len(ranked) >= limit:
                    break
    return ranked


class GuessCost:
    """Minimum-cost segmentation of a value; costs are log10 of guesses."""

    def __init__(self, ranked: dict[str, int]):
        self.ranked = ranked
        self.longest = min(max(map(len, ranked)), LONGEST_SEGMENT)
        self.walks: dict[str, tuple[int, int]] = {}
        for r, row in enumerate((*KEYBOARD_ROWS, "0123456789", "abcdefghijklmnopqrstuvwxyz")):
            for way in (row, row[::-1]):
                for k, c in enumerate(way[:-1]):
                    self.walks.setdefault(c + way[k + 1], (r, 1 if way is row else -1))

    @staticmethod
    def alphabet(c: str) -> float:
        """log10 of the alphabet that a brute-force guess of ``c`` runs through."""
        if c.isdigit():
            return 1.0
        if c.isalpha():
            return math.log10(26) if c.isascii() else math.log10(200)
        return math.log10(33)

    def _case(self, word: str) -> float:
        """Guesses for the upper-case letters of a dictionary word."""
        upper = sum(c.isupper() for c in word)
        if not upper:
            return 0.0
        if upper == len(word) or word[0].isupper() and upper == 1:
            return math.log10(2)
        return math.log10(sum(math.comb(len(word), k) for k in range(1, min(upper, len(word) - upper) + 1)) + 1)

    def segments(self, value: str, at: int, forms: tuple[str, str] | None = None, stops: dict[int, int] | None = None) -> Iterator[tuple[int, float, str]]:
        """Segments that start at ``at``: end, cost, kind.  ``stops`` keeps, from
        place to place, where each period breaks off, so a value is read once."""
        lower, plain = forms or self.forms(value)
        stops = {} if stops is None else stops
        n = len(value)
        for end in range(at + 3, min(n, at + self.longest) + 1):
            rank = self.ranked.get(lower[at:end])
            if rank is not None:
                yield end, math.log10(rank + 1) + self._case(value[at:end]), "word"
            elif plain[at:end] != lower[at:end] and (rank := self.ranked.get(plain[at:end])) is not None:
                yield end, math.log10(rank + 1) + self._case(value[at:end]) + math.log10(4), "word"
        for length in (4, 6, 7, 8, 10):
            if at + length <= n and DATE.fullmatch(value, at, at + length):
                yield at + length, math.log10(365 * 120 if length > 4 else 120), "date"
        for period in (1, 2, 3, 4):
            if stops.get(period, -1) < at:
                stop = at
                while stop + period < n and value[stop] == value[stop + period]:
                    stop += 1
                stops[period] = stop
            times = (period + stops[period] - at) // period
            if times >= 2 and (period > 1 or times >= 3):
                base = sum(self.alphabet(c) for c in value[at:at + period])
                yield at + times * period, base + math.log10(times), "repeat"
        end, step = at + 1, self.walks.get(lower[at:at + 2])
        while end < n and step is not None and self.walks.get(lower[end - 1:end + 1]) == step:
            end += 1
            if end - at >= 3:
                yield end, math.log10(47 * 2 * (end - at)), "walk"

    @staticmethod
    def forms(value: str) -> tuple[str, str]:
        """The value in lower case (where that keeps its length), and with lookalikes as letters."""
        lower = value.lower()
        lower = lower if len(lower) == len(value) else value
        return lower, lower.translate(LOOKALIKE)

    def _paths(self, value: str, best: list[float], back: list[tuple[int, str]], below: float = math.inf) -> Iterator[tuple[int, int]]:
        """Fill the cheapest way to every place.  Yields each place that is done
        and the last place reached so far at a cost under ``below``."""
        forms, stops, last = self.forms(value), {}, 0
        for at in range(len(value)):
            brute = back[at][1] == "brute"  # a brute-force span goes on at no cost but the character's
            moves = [(at + 1, self.alphabet(value[at]) - (SEGMENT_COST if brute else 0.0), "brute")]
            for end, cost, kind in (*moves, *self.segments(value, at, forms, stops)):
                cost += best[at] + SEGMENT_COST
                if cost < best[end]:
                    best[end], back[end] = cost, (at, kind)
                if cost < below and end > last:
                    last = end
            yield at, last

    def segmentation(self, value: str) -> tuple[float, list[tuple[int, int, str]]]:
        """log10 guesses of the whole value, and its segments (start, end, kind)."""
        best, back = [0.0] + [math.inf] * len(value), [(0, "")] * (len(value) + 1)
        for _ in self._paths(value, best, back):
            pass
        parts, end = [], len(value)
        while end:
            at, kind = back[end]
            if kind == "brute" and parts and parts[-1][2] == "brute":
                parts[-1] = (at, parts[-1][1], kind)
            else:
                parts.append((at, end, kind))
            end = at
        return best[-1], parts[::-1]

    def reaches(self, value: str, threshold: float) -> bool:
        """Whether the whole value costs ``threshold`` or more.  Told early: once
        one way to the end is cheaper, or no place ahead is reached below it."""
        best, back = [0.0] + [math.inf] * len(value), [(0, "")] * (len(value) + 1)
        for at, last in self._paths(value, best, back, threshold):
            if best[-1] < threshold:
                return False
            if last <= at:
                return True
        return best[-1] >= threshold


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the three patterns: start, end, kind."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return found


def guess_spans(text: str, cost: GuessCost, threshold: float, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in a credential context that cost ``threshold`` or more and do
    not lie wholly in spans found already; they may overlap them."""
    found, covered = [], None
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            if covered is None:
                covered = bytearray(len(text))
                for start, end, _ in taken:
                    covered[start:end] = b"\x01" * (end - start)
            a, b = m.span(1)
            if 0 in covered[a:b] and cost.reaches(m[1], threshold):
                found.append((a, b, "guess"))
                covered[a:b] = b"\x01" * (b - a)
    return found


@functools.lru_cache(maxsize=2)
def _model(ranked: tuple[str, ...]) -> GuessCost:
    return GuessCost({w: k for k, w in enumerate(ranked, 1)})


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def scan(docs: DataFrame, ranked: dict[str, int], threshold: float = MIN_LOG10_GUESSES, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """``docs`` with ``out_col``: an array of (start, end, kind) in code points,
    ordered by start, then by kind as listed in KINDS."""
    words = docs.sparkSession.sparkContext.broadcast(tuple(sorted(ranked, key=ranked.get)))

    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def spans(texts):
        import pandas as pd

        cost = _model(words.value)

        def one(text: str | None) -> list[dict]:
            found = base_spans(text or "")
            found += guess_spans(text or "", cost, threshold, found)
            found.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
            return [{"start": a, "end": b, "kind": kind} for a, b, kind in found]

        return pd.Series([one(t) for t in texts], dtype=object)

    return docs.withColumn(out_col, spans(F.col(text_col)))


def joined_spans(spans: str, keep: str | None = None):
    """Spans as ``kind:start:end``, comma-joined (only where ``keep`` holds)."""
    source = f"filter({spans}, x -> {keep})" if keep else spans
    return F.expr(f"array_join(transform({source}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def redact(docs: DataFrame, spans: str = "secrets", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping
    spans once).  Built-in functions only: the text is put together from the
    gaps between merged spans."""
    merged = F.expr(f"""aggregate(sort_array({spans}), cast(array() as array<struct<start:int,end:int>>), (done, x) ->
        if(size(done) > 0 and element_at(done, -1).end >= x.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end)))),
           concat(done, array(named_struct('start', x.start, 'end', x.end)))))""")
    gaps = F.expr(f"""concat_ws('{mark}', transform(sequence(0, size(_merged)), k ->
        substring({text_col}, if(k = 0, 1, get(_merged, k - 1).end + 1),
            if(k = size(_merged), length({text_col}), get(_merged, k).start) - if(k = 0, 0, get(_merged, k - 1).end))))""")
    kept = docs.columns
    out = docs.withColumn("_merged", merged).withColumn("_redacted", F.when(F.size("_merged") > 0, gaps).otherwise(F.col(text_col)))
    return out.select(*[F.col("_redacted").alias(c) if c == text_col else F.col(c) for c in kept])
