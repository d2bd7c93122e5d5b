"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers expand them."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import tidy

# The base kinds in the order in which spans of one start are listed, then the added ones.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "address")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
DIGITS = frozenset("0123456789")
PHONE = frozenset(" ().0123456789-")
SCHEMES = ("http://", "https://", "ftp://", "www.")
ACCOUNT_CUES = ("IBAN", "iban", "Iban", "account", "Account", "Konto", "konto", "compte", "Compte", "cuenta", "Cuenta")
STREET_CUES = (
    " Street", " Avenue", " Road", " Lane", " Boulevard", "straße", "strasse", "Rue ", "rue ", "Calle ", "calle ",
)
_URL = re.compile(r"[!-~]+")
_HOST = re.compile(r"(?:[a-z]+://)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?=[:/?#]|$)")
_ACCOUNT = re.compile(r"\W{0,3}(?:(?:number|no|Nr|num|nummer)\.?\W{0,3})?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}|[0-9]{6,18})(?![A-Za-z0-9])")
_NUMBER_BEFORE = re.compile(r"(?<![0-9.,])([0-9]{1,5}[A-Za-z]?(?: [A-Z][\w'-]*){1,3})$")
_NUMBER_AFTER = re.compile(r"[A-Za-z]{0,2} ([0-9]{1,5})(?![0-9.,])")
_NAME_AFTER = re.compile(r"((?:[\w'-]+ ){0,4}[\w'-]+),? ([0-9]{1,5})(?![0-9.,])")


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    kinds = {"@": "email", "+": "phone", **dict.fromkeys("0123456789", "digit")}
    kinds |= dict.fromkeys(SCHEMES, "url") | dict.fromkeys(ACCOUNT_CUES, "account") | dict.fromkeys(STREET_CUES, "address")
    for text, kind in kinds.items():
        auto.add_word(text, (kind, len(text)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _run(text: str, at: int, chars: frozenset, end: int) -> int:
    while at < end and text[at] in chars:
        at += 1
    return at


def _email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """Around the at-sign at ``at``: the local part back to ``free`` at most, then labels joined by dots."""
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL, len(text))
    if start == at or end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        further = _run(text, end + 1, LABEL, len(text))
        if further == end + 1:
            break
        end, dots = further, dots + 1
    return (start, end, True) if dots else None


def _ip(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """From the digit at ``at``, the first of its run after ``free``: four runs of digits joined by dots."""
    end, good = at, True
    for part in range(4):
        if part:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        begin, end = end, _run(text, end, DIGITS, len(text))
        if begin == end:
            return None
        number = text[begin:end].lstrip("0")
        good &= len(number) <= 3 and int(number or 0) <= 255
    return at, end, good


def _card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """From the digit at ``at``: digits with at most one blank or hyphen between two."""
    end, digits = at + 1, [text[at]]
    while end < len(text):
        step = 1 if text[end] in " -" else 0
        if end + step >= len(text) or text[end + step] not in DIGITS:
            break
        digits.append(text[end + step])
        end += step + 1
    if len(digits) < 2:
        return None
    return at, end, 12 <= len(digits) <= 19 and luhn("".join(digits))


def _phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    """From the plus at ``at``: a digit, then phone characters up to their last digit."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, PHONE, len(text))
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    return at, end, 9 <= sum(c in DIGITS for c in text[at:end]) <= 15


def _url(text: str, at: int, size: int) -> tuple[int, int] | None:
    end = _URL.match(text, at).end()
    while end > at and text[end - 1] in ".,;:!?)]}'\">":
        end -= 1
    return (at, end) if _HOST.match(text[at:end]) else None


def _iban(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _account(text: str, at: int, size: int) -> tuple[int, int] | None:
    found = _ACCOUNT.match(text, at + size)
    if not found:
        return None
    value, (start, end) = found[1], found.span(1)
    if value[0] in DIGITS:
        return start, end
    while end - start >= 15:  # trailing words of capitals may belong to the sentence
        if _iban(text[start:end]):
            return start, end
        end = text.rfind(" ", start, end)
    return None


def _address(text: str, at: int, size: int) -> tuple[int, int] | None:
    cue = text[at : at + size]
    if cue[0] == " ":
        before = _NUMBER_BEFORE.search(text, max(0, at - 80), at)
        return (before.start(1), at + size) if before else None
    if cue[-1] == " ":
        if at and text[at - 1].isalnum():
            return None
        after = _NAME_AFTER.match(text, at + size)
        return (at, after.end()) if after else None
    after = _NUMBER_AFTER.match(text, at + size)
    start = at
    while start and (text[start - 1].isalpha() or text[start - 1] == "-"):
        start -= 1
    return (start, after.end(1)) if after and start < at else None


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all personal data, by start and then by kind; code points, end exclusive.

    Base kinds follow their patterns exactly: leftmost, not overlapping within a kind; a match that
    fails its test is used up and dropped.
    """
    free = dict.fromkeys(BASE, 0)
    spans: list[tuple[int, int, str]] = []
    extra: list[tuple[int, int, str]] = []

    def take(kind: str, found: tuple[int, int, bool] | None) -> None:
        if found:
            free[kind] = found[1]
            if found[2]:
                spans.append((found[0], found[1], kind))

    last_digit = -2
    for end, (kind, size) in anchors().iter(text):
        at = end - size + 1
        if kind == "digit":
            opens = last_digit != at - 1
            last_digit = at
            # Only the first free digit of a run can begin a match; further ones fail like it.
            if at >= free["ip"] and (opens or at == free["ip"]):
                take("ip", _ip(text, at, free["ip"]))
            if at >= free["card"]:
                take("card", _card(text, at, free["card"]))
        elif kind == "email":
            if at >= free["email"]:
                take("email", _email(text, at, free["email"]))
        elif kind == "phone":
            if at >= free["phone"]:
                take("phone", _phone(text, at, free["phone"]))
        else:
            found = {"url": _url, "account": _account, "address": _address}[kind](text, at, size)
            if found and not any(found[0] < b and a < found[1] and k == kind for a, b, k in extra[-2:]):
                extra.append((*found, kind))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans + extra, key=lambda s: (s[0], order[s[2]]))


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first wins."""
    out, at = [], 0
    for start, end, kind in spans:
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def join(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_in_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", masked: bool = False) -> DataFrame:
    """Counts, digest and spans of personal data per row; with ``masked``, also the text without it.

    Null text counts as empty: no spans, masked text null. Null ids and repeated rows stay rows of their own.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts, digests, spans, masks = {k: [] for k in BASE}, [], [], []
                for value in part.column(1):
                    text = value.as_py()
                    found = find(text or "")
                    base = [s for s in found if s[2] in counts]
                    for kind, column in counts.items():
                        column.append(sum(s[2] == kind for s in base))
                    digests.append(hashlib.sha256(join(base).encode()).hexdigest())
                    spans.append(join(found))
                    masks.append(None if text is None else mask(text, found) if masked else None)
                arrays = [part.column(0), *(pa.array(c, pa.int64()) for c in counts.values()), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
                names = [id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans"]
                if masked:
                    arrays, names = [*arrays, pa.array(masks, pa.string())], [*names, "masked_text"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), schema + (", masked_text string" if masked else ""))


def masked_text(column: Column) -> Column:
    """The text column without personal data; null stays null."""

    def replace(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else mask(t, find(t)))

    return F.pandas_udf(replace, "string")(column)
