"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, URL schemes, plus
signs, digits, and cue words of identifiers. Around each anchor a small parser
expands to the boundaries of an e-mail address, network address, card, phone,
account or secret and validates it. Text without anchors is passed once and
never parsed; every parser moves forward only, so long runs cost linear time.
Cues count in any case. Values, keys and the blanks before them have no upper
bound: a span ends where its characters do, so no tail is left unmasked.

Offsets count code points; ends are exclusive. Spans of one kind do not
overlap, spans of different kinds may. Defined results: a null or empty text
has no spans and stays as it is; repeated rows are treated alike; an empty
table gives an empty table; extra columns are handed on by ``redact``.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "account", "secret", "url")
BASE = KINDS[:4]
EMAIL, IP, CARD, PHONE, ACCOUNT, SECRET, URL = range(7)

# Forms of the base kinds.
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Cues that a value of the kind follows, and forms of it.
_CUES = {
    "iban": ACCOUNT, "account": ACCOUNT, "acct": ACCOUNT, "konto": ACCOUNT, "cuenta": ACCOUNT, "compte": ACCOUNT,
    "passport": ACCOUNT, "ssn": ACCOUNT, "social security": ACCOUNT, "driver license": ACCOUNT, "tax id": ACCOUNT,
    "password": SECRET, "passwd": SECRET, "pwd": SECRET, "api_key": SECRET, "api-key": SECRET, "apikey": SECRET,
    "api key": SECRET, "secret": SECRET, "token": SECRET,
}
_SCHEMES = ("http://", "https://", "ftp://", "ssh://", "smb://", "postgres://", "mysql://", "mongodb://", "redis://")
_KEYS = ("akia", "asia", "ghp_", "xoxb-", "xoxp-")
_ACCOUNT = re.compile(r"[\x20\t]*+(?:(?ai:no|nr|num|number|id)\b[.:]?)?[\x20\t]*+[:#=]?[\x20\t]*+(?=[A-Za-z0-9])")
_GROUP = re.compile(r"[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*")
_IBAN = re.compile(r"[A-Za-z]{2}[\x20-]?[0-9][\x20-]?[0-9](?:[\x20-]?[A-Za-z0-9]){11,30}")
_SECRET = re.compile(r"[\"']?[\x20\t]*+[:=][\x20\t]*+[\"']?")
_VALUE = re.compile(r"[^\s\"',;]{6,}")
_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}[0-9A-Za-z]*|ghp_[0-9A-Za-z]{36,}|xox[bp]-[0-9A-Za-z-]{10,}")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>]*")
_WORD = re.compile(r"\w")

_DIGIT, _AT, _PLUS, _SCHEME, _KEYED, _CUE = range(6)


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, (_DIGIT, 1, None))
    found.add_word("@", (_AT, 1, None))
    found.add_word("+", (_PLUS, 1, None))
    for scheme in _SCHEMES:
        found.add_word(scheme, (_SCHEME, len(scheme), None))
    for key in _KEYS:
        found.add_word(key, (_KEYED, len(key), None))
    for cue, kind in _CUES.items():
        found.add_word(cue, (_CUE, len(cue), kind))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _octet(part: str) -> bool:
    small = part.lstrip("0")
    return len(small) < 3 or len(small) == 3 and small <= "255"


def _addresses(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Four dotted numbers within a run of digits and dots, left to right.

    A greedy match takes whole numbers, so matches are groups of four
    neighbours; a group that fails validation is passed as a whole.
    """
    parts, places, at = text[begin:end].split("."), [], begin
    for part in parts:
        places.append(at)
        at += len(part) + 1
    k = 0
    while k + 3 < len(parts):
        four = parts[k : k + 4]
        if all(four):
            if all(map(_octet, four)):
                yield places[k], places[k + 3] + len(four[3])
            k += 4
        else:
            k += 1


def _iban(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _account(text: str, start: int) -> int:
    """Where the account number that begins here ends; ``start`` if none does."""
    if match := _IBAN.match(text, start):
        flat, ends = "", []
        for k, c in enumerate(match[0], start + 1):
            if c not in " -":
                flat += c.upper()
                ends.append(k)
        for n in range(len(flat), 14, -1):
            if _iban(flat[:n]):
                return ends[n - 1]
    # Else up to the last group that holds digits: words that follow are text.
    end, digits, at = start, 0, start
    while group := _GROUP.match(text, at):
        own = sum(c.isdigit() for c in group[0])
        if not own:
            break
        digits, end = digits + own, group.end()
        at = end + (text[end : end + 1] in (" ", "-"))
        if at == end:
            break
    return end if digits >= 5 else start


def _lowered(text: str) -> str:
    """The text in lower case, with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span, by start, then kind."""
    if not text:
        return []
    out: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)  # where the last match of each kind ended
    numbers = cards = at_sign = 0
    for last, (anchor, size, kind) in _ANCHORS.iter(_lowered(text)):
        p = last + 1 - size
        if anchor == _DIGIT:
            if p >= numbers:
                numbers = _NUMBERS.match(text, p).end()
                out += [(a, IP, b) for a, b in _addresses(text, p, numbers)]
            if p >= cards:
                cards = _CARD.match(text, p).end()
                if cards - p >= 12:
                    digits = text[p:cards].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((p, CARD, cards))
        elif anchor == _AT:
            before = text[max(done[EMAIL], at_sign) : p]
            start = p - len(before) + len(before.rstrip(_LOCAL))
            at_sign = p + 1
            if start < p and (match := _DOMAIN.match(text, p + 1)):
                out.append((start, EMAIL, match.end()))
                done[EMAIL] = match.end()
        elif anchor == _PLUS:
            if p >= done[PHONE] and (match := _PHONE.match(text, p)):
                done[PHONE] = match.end()
                if 9 <= sum(c in string.digits for c in match[0]) <= 15:
                    out.append((p, PHONE, match.end()))
        elif anchor == _SCHEME:
            # An address that carries a user and a password.
            match = _AUTHORITY.match(text, last + 1)
            if p >= done[URL] and ":" in match[0].rpartition("@")[0]:
                out.append((p, URL, match.end()))
                done[URL] = match.end()
        elif anchor == _KEYED:
            free = p == 0 or not _WORD.match(text, p - 1)
            if free and p >= done[SECRET] and (match := _KEY.match(text, p)):
                out.append((p, SECRET, match.end()))
                done[SECRET] = match.end()
        elif p == 0 or not _WORD.match(text, p - 1) or text[p - 1] == "_":
            if kind == SECRET:
                # A value has no bound: one that starts within the last is not read again.
                sign = _SECRET.match(text, last + 1)
                if sign and sign.end() >= done[SECRET] and (match := _VALUE.match(text, sign.end())):
                    out.append((match.start(), SECRET, match.end()))
                    done[SECRET] = match.end()
            elif (match := _ACCOUNT.match(text, last + 1)) and match.end() >= done[ACCOUNT]:
                end = _account(text, match.end())
                if end > match.end():
                    out.append((match.end(), ACCOUNT, end))
                    done[ACCOUNT] = end
    out.sort()
    return out


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``spans`` (kind, start, end) of every row."""
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], ["id", "spans"])

    schema = "id long, spans array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def masked(text: str | None) -> str | None:
    """A text with each stretch of spans replaced by the kind of its first one."""
    if not text:
        return text
    out, at = [], 0
    for start, kind, end in spans(text):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with personal data masked; ``length``, if the table has it, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            clean = pa.array([masked(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    out = docs.mapInArrow(run, docs.schema)
    if length in docs.columns:
        same = F.when(F.col(text).isNull(), F.col(length)).otherwise(F.length(text))
        out = out.withColumn(length, same.cast(docs.schema[length].dataType))
    return out


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
