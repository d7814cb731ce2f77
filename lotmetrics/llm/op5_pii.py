r"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a whole text: at-signs, schemes,
plus signs, digits and account cues.  At each anchor a deterministic local
parser expands to the span's boundaries and validates it.  Spans of one kind
never overlap: an anchor before the end of the kind's last expansion is passed.

Kinds, in their order: email, ip, card, phone (the base), then url (a scheme with
a user and password before the at-sign) and account (an IBAN with valid check
digits after the cue `IBAN`, or a social security number after the cue `SSN`).

Null texts are empty; empty texts have no spans.  Each row is searched by
itself, so repeated rows and ids have equal results; an empty table gives none.
Texts are searched whole, in a time that grows with their length; columns that are
not kept are not read, and kept ones may have any name but `pii`.
"""

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_names, free_name, table

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL, LABEL, CALL = ALNUM | frozenset("._%+-"), ALNUM | {"-"}, DIGITS | frozenset(" ().-")
USER = ALNUM | frozenset("._~%!$&'()*+,;=-:")
#: The anchors of each parser.
CUES = {"@": "email", "://": "url", "+": "phone", "IBAN": "account", "SSN": "account"} | {d: "digit" for d in DIGITS}


def run(s: str, at: int, chars: frozenset) -> int:
    """The end of the characters from at that are in chars."""
    n = len(s)
    while at < n and s[at] in chars:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def email_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    """Around the at-sign at `at`, not before since."""
    start = at
    while start > since and s[start - 1] in LOCAL:
        start -= 1
    end = run(s, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while s[end : end + 1] == "." and (more := run(s, end + 1, LABEL)) > end + 1:
        end, dots = more, dots + 1
    return (start, end, True) if dots else None


def ip_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    """From the run of digits that begins at `at`."""
    end = run(s, at, DIGITS)
    for _ in range(3):
        if s[end : end + 1] != "." or (more := run(s, end + 1, DIGITS)) == end + 1:
            return None
        end = more
    return at, end, all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s[at:end].split("."))


def card_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    end = run(s, at, DIGITS)
    while s[end : end + 1] in (" ", "-") and s[end + 1 : end + 2] in DIGITS:
        end = run(s, end + 1, DIGITS)
    if end - at < 2:
        return None
    digits = s[at:end].replace(" ", "").replace("-", "")
    return at, end, 14 <= len(digits) <= 19 and luhn(digits)


def phone_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    if s[at + 1 : at + 2] not in DIGITS:
        return None
    end = run(s, at + 2, CALL)
    while end > at + 2 and s[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 10 <= sum(c in DIGITS for c in s[at:end]) <= 15


def url_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    """A scheme before `://` and user:password@host after it."""
    start = at
    while start > since and s[start - 1] in ALNUM:
        start -= 1
    end = run(s, at + 3, USER)
    if start == at or s[end : end + 1] != "@" or ":" not in s[at + 3 : end]:
        return None
    host = run(s, end + 1, LABEL | {"."})
    return (start, host, True) if host > end + 1 else None


def account_at(s: str, at: int, since: int) -> tuple[int, int, bool] | None:
    """The number after a cue and up to three of ` :#`; spaces may group an IBAN, dashes a security number."""
    iban = s.startswith("IBAN", at)
    start = run(s, at + (4 if iban else 3), frozenset(" :#"))
    if start == at + (4 if iban else 3) or start > at + 7:
        return None
    if not iban:
        end = run(s, start, DIGITS | {"-"})
        return start, end, [len(x) for x in s[start:end].split("-")] == [3, 2, 4]
    end, code = start, ""
    while end < len(s) and len(code) < 34 and (s[end] in ALNUM or s[end] == " " and s[end + 1 : end + 2] in ALNUM):
        code += s[end].strip()
        end += 1
        if len(code) >= 15 and code[:2].isalpha() and code[2:4].isdigit() and s[end : end + 1] not in ALNUM and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return start, end, True
    return None


def automaton(cues: dict = CUES) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for cue, kind in cues.items():
        made.add_word(cue, (len(cue), kind))
    made.make_automaton()
    return made


PARSERS = {"email": email_at, "ip": ip_at, "card": card_at, "phone": phone_at, "url": url_at, "account": account_at}


def spans(s: str, cues: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    out, done = [], dict.fromkeys(KINDS, 0)
    for last, (length, anchor) in cues.iter(s):
        at = last - length + 1
        for kind in ("ip", "card") if anchor == "digit" else (anchor,):
            if at < done[kind]:
                continue
            if kind == "ip" and at > done[kind] and s[at - 1] in DIGITS:
                continue  # inside a run of digits that failed from its start
            found = PARSERS[kind](s, at, done[kind])
            if found is None:
                continue
            start, end, valid = found
            done[kind] = end
            if valid:
                out.append((start, end, kind))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


SPANS = "array<struct<start:int,end:int,kind:string>>"


def _find(batches):
    """Appends the spans to each row; the first column is the text."""
    cues = automaton()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    for b in batches:
        found = [[{"start": x, "end": y, "kind": k} for x, y, k in spans(t, cues)] if t else [] for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(found, kind)], names=[*b.schema.names[1:], "pii"])


def find_pii(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, and pii: all spans in code points, end exclusive; ValueError if a kept column is called pii."""
    distinct_names(keep, ("pii",))
    rows = docs.select(F.col(text).alias(free_name(docs.select(*keep), "_text")), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(_find, f"{fields}, pii {SPANS}")


def redact(s: str | None, cues: ahocorasick.Automaton) -> str | None:
    """Each maximal stretch of overlapping spans becomes the first one's [KIND]."""
    found = spans(s, cues) if s else []
    if not found:
        return s
    out, at, k = [], 0, 0
    while k < len(found):
        start, end, kind = found[k]
        k += 1
        while k < len(found) and found[k][0] < end:
            end, k = max(end, found[k][1]), k + 1
        out += (s[at:start], f"[{kind.upper()}]")
        at = end
    return "".join(out) + s[at:]


def redact_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with each span of its text replaced by its kind."""
    place = docs.columns.index(text)

    def masked(batches):
        cues = automaton()
        for b in batches:
            yield b.set_column(place, b.schema.field(place), pa.array([redact(t, cues) for t in b.column(place).to_pylist()], b.schema.field(place).type))

    return docs.mapInArrow(masked, docs.schema)


DIGESTS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _digests(batches):
    for b in batches:
        rows = [[(f"{x['kind']}:{x['start']}:{x['end']}", x["kind"]) for x in found] for found in b.column("pii").to_pylist()]
        base = [",".join(t for t, k in r if k in BASE) for r in rows]
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), *(pa.array([sum(k == kind for _, k in r) for r in rows], pa.int64()) for kind in BASE),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()), pa.array([",".join(t for t, _ in r) for r in rows], pa.string()),
        ], names=[x.rpartition(" ")[0] for x in DIGESTS.split(", ")])


def op5_anchor_expansion(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).mapInArrow(_digests, DIGESTS)
