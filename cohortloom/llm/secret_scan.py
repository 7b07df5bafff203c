"""Secret scans: base patterns, and a lexer for assignments in source and configuration text.

The lexer reads name-literal pairs of several syntaxes: assignments (``name = "x"``, ``name: x``, ``"name": "x"``,
``export NAME=x``, ``name := 'x'``, ``name => 'x'``, ``f(name="x")``), with triple-quoted literals and header schemes
(``auth: Bearer x``); YAML block scalars; elements (``<name>x</name>``) and attributes (``key="name" value="x"``); and
call arguments (``name("x")``, ``put("name", "x")``). Then names on the right-hand side are followed to the literals
they are given anywhere in the text, and concatenations are folded. Every value is scored by the sensitive words of the
names it ends up in, its length and the variety of its characters; the literals of one that scores high enough are
spans of kind ``literal``.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
# a run that is too short matches nowhere within itself, so the length can stand in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
MIN_VALUE = 6
MIN_SCORE = 3.0
SPAN = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"

# weight of a word of a name
NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 3.0, "pass": 2.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "cred": 2.0, "creds": 2.0, "auth": 1.5, "bearer": 2.0,
    "key": 1.0, "api": 1.0, "private": 1.0, "access": 1.0, "client": 0.5, "signing": 1.0, "encryption": 1.0,
    "salt": 1.0, "dsn": 1.0, "conn": 0.5, "connection": 0.5, "authorization": 2.0,
}
# names that mention a secret without holding one
HARMLESS_WORDS = {"file", "path", "url", "uri", "name", "id", "type", "length", "len", "count", "policy", "field",
                  "label", "hint", "expiry", "expires", "ttl", "regex", "pattern", "public", "reset"}
PLACEHOLDERS = re.compile(
    r"(?i)\A(?:x+|\*+|\.+|-+|<.*>|\$\{.*|\{\{.*|%\(?.*|null|none|true|false|nil|undefined|changeme|example\w*|"
    r"your\w*|password|passwd|secret|token|string|str|int|bool|env|todo|redacted|required|optional)\Z"
)
_TARGET = r"""["'`]?(?P<name>[A-Za-z_$][A-Za-z0-9_$.\-]{0,127}|[A-Za-z_$][A-Za-z0-9_$]{0,127}(?:\[["'][^"'\]\n]{1,127}["']\])?)["'`\]]?"""
_QUOTED = r"""(?:"(?P<dq>(?:[^"\\\n]|\\.)*)"|'(?P<sq>(?:[^'\\\n]|\\.)*)'|`(?P<bq>[^`\n]*)`)"""
_TRIPLE = r"""(?:\"{3}(?P<tdq>(?s:.){0,4096}?)\"{3}|'{3}(?P<tsq>(?s:.){0,4096}?)'{3})"""
_BARE = r"""(?P<bare>[^\s"'`,;(){}\[\]<>#&|]+)"""
_PAIR = re.compile(
    rf"(?<![A-Za-z0-9_$.\-]){_TARGET}"
    r"[\x20\t]*(?:=>|:=|\?=|\+=|==?=?(?!=)|:(?![:/]))[\x20\t]*"
    r"(?:(?P<prefix>[bruf]{1,2})(?=[\"']))?"
    rf"(?:{_TRIPLE}|{_QUOTED}|(?:[Bb]earer|[Bb]asic|[Tt]oken)\x20+(?P<scheme>[A-Za-z0-9._~+/=-]{{6,}})|{_BARE})",
)
# what may follow a literal or a name: an operator that joins texts, or the next literal on the same or a continued line
_JOINED = re.compile(
    rf"(?:[\x20\t]*\\?\n?[\x20\t]*(?:\+|\.\.?(?=[\x20\"'])|&(?!&)|\|\|)[\x20\t]*\\?\n?[\x20\t]*(?:{_QUOTED}|(?P<bare>[A-Za-z_][A-Za-z0-9_.]{{0,127}}(?![A-Za-z0-9_.(])))"
    rf"|[\x20\t]*(?:\\\n)?[\x20\t]*{_QUOTED.replace('P<', 'P<next_')})"
)
_BLOCK = re.compile(
    r"^(?P<indent>[\x20\t]*)(?:-\x20+)?[\"']?(?P<name>[A-Za-z_][A-Za-z0-9_.\-]{0,127})[\"']?[\x20\t]*:[\x20\t]*[|>][+-]?[0-9]?[\x20\t]*\n"
    r"(?P<value>(?:(?P=indent)[\x20\t]+[^\n]*(?:\n|\Z)|[\x20\t]*\n)+)",
    re.M,
)
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.:\-]{0,127})(?:\s[^<>]*)?>(?P<value>[^<>]+)</(?P=name)\s*>")
_TAG = re.compile(r"<[A-Za-z][^<>]*>")
_ATTRIBUTE = re.compile(r"""([A-Za-z_][A-Za-z0-9_.:\-]{0,127})\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)')""")
_NAMING = ("key", "name", "property", "id")
_CALL = re.compile(rf"(?<![A-Za-z0-9_$])(?P<name>[A-Za-z_$][A-Za-z0-9_$.]{{0,127}})\(\s*{_QUOTED}\s*(?P<end>\)|,\s*{_QUOTED.replace('P<', 'P<next_')})")
# functions that look a secret up by the argument, or only look at it
LOOKING = {"get", "fetch", "load", "read", "find", "lookup", "input", "prompt", "env", "getenv", "check", "validate", "verify",
           "is", "has", "contains", "print", "log", "echo"}
# a text of several words with one of these is a sentence and no passphrase
SENTENCE_WORDS = {"the", "a", "an", "your", "you", "enter", "please", "is", "are", "must", "be", "to", "for", "of", "and", "or",
                  "in", "with", "not", "this", "that", "new", "password", "secret", "token", "invalid", "here"}
# a value that takes more steps or parts than any program's is not folded
MAX_STEPS, MAX_PARTS = 8, 64
_NAME_ONLY = re.compile(r"\A(?:\$\{?|process\.env\.|os\.environ\.)?([A-Za-z_][A-Za-z0-9_.]{0,127})\}?\Z")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three base patterns, by kind; values that are too short are dropped with all they cover."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def name_weight(name: str) -> float:
    """How sensitive a name is: the sum of its words' weights, less when a word says it holds no secret."""
    words = [w.lower() for w in _CAMEL.findall(name)]
    weight = sum(NAME_WEIGHTS.get(w, 0.0) for w in words)
    return weight - 2.0 * sum(w in HARMLESS_WORDS for w in words)


def literal_weight(value: str) -> float:
    """How much a literal looks like a secret: by length, kinds of characters and entropy; placeholders do not.

    Of several lines the best one counts. Four words or more are a passphrase if none of them makes a sentence.
    """
    if "\n" in value:
        return max((literal_weight(line.strip()) for line in value.split("\n") if line.strip()), default=-10.0)
    words = value.split()
    if len(value) < MIN_VALUE or PLACEHOLDERS.match(value):
        return -10.0
    if len(words) > 3:
        plain = [w.strip(".,-_").lower() for w in words]
        return 0.5 if len(words) <= 12 and all(w.isalnum() for w in plain) and not SENTENCE_WORDS.intersection(plain) else -10.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.5, max(0.0, entropy - 2.0)) + 0.5 * (kinds - 1) + (0.5 if n >= 12 else 0.0)


# a part of a value: the span of a literal, or a name that stands for one
Part = tuple[int, int] | str
_VALUES = ("tdq", "tsq", "dq", "sq", "bq", "scheme", "bare")


def _part(m: re.Match, groups: Sequence[str]) -> tuple[str, tuple[int, int]]:
    group = next(g for g in groups if m[g] is not None)
    return group, m.span(group)


def _assignments(text: str) -> Iterator[tuple[int, str, list[Part], bool]]:
    """(place, name, parts, whether a single bare word) of every assignment, from left to right."""
    at = 0
    while m := _PAIR.search(text, at):
        at = m.end()
        group, span = _part(m, _VALUES)
        reference = _NAME_ONLY.match(m["bare"]) if group == "bare" else None
        parts: list[Part] = [reference[1] if reference else span]
        if reference:
            # a name may be followed by a pair of its own
            at = max(m.start(group), m.start() + 1)
        end = m.end()
        while group != "scheme" and (more := _JOINED.match(text, end)):
            names = [g for g in more.groupdict() if more[g] is not None]
            if names[0].startswith("next_") and group == "bare":
                break
            parts.append(more[names[0]] if names[0] == "bare" else more.span(names[0]))
            group, end = names[0], more.end()
        at = max(at, end) if len(parts) > 1 else at
        name = f"{m['name']}.bearer" if group == "scheme" else m["name"]
        yield m.start(), name, parts, reference is not None and len(parts) == 1


def _other_pairs(text: str) -> Iterator[tuple[int, str, list[Part]]]:
    """Pairs of block scalars, elements, attributes and call arguments."""

    def trimmed(m: re.Match, group: str) -> list[Part]:
        value = m[group]
        low = m.start(group) + len(value) - len(value.lstrip())
        return [(low, m.start(group) + len(value.rstrip()))]

    if ":" in text and ("|" in text or ">" in text):
        for m in _BLOCK.finditer(text):
            if m["value"].strip():
                yield m.start(), m["name"], trimmed(m, "value")
    if "<" in text:
        for m in _ELEMENT.finditer(text):
            if m["value"].strip():
                yield m.start(), m["name"].rpartition(":")[2], trimmed(m, "value")
        for tag in _TAG.finditer(text):
            held = {m[1].lower(): m for m in _ATTRIBUTE.finditer(text, tag.start(), tag.end())}
            naming = next((held[k] for k in _NAMING if k in held), None)
            if naming is not None and "value" in held:
                value = held["value"]
                yield tag.start(), naming[2] or naming[3] or "", [value.span(2 if value[2] is not None else 3)]
    if "(" in text:
        for m in _CALL.finditer(text):
            first = _part(m, ("dq", "sq", "bq"))
            if m["end"] != ")":
                yield m.start(), text[slice(*first[1])], [_part(m, ("next_dq", "next_sq", "next_bq"))[1]]
            elif not LOOKING.intersection(w.lower() for w in _CAMEL.findall(m["name"])):
                yield m.start(), m["name"], [first[1]]


def assigned_literals(text: str) -> list[tuple[int, int, str, float]]:
    """Literals whose names make them secrets: (start, end, name, score), each literal once with its best name."""
    pairs, known = [], {}
    for place, name, parts, bare in _assignments(text):
        pairs.append((place, name, parts, bare))
        for alias in {name, name.rpartition(".")[2]}:
            places, given = known.setdefault(alias, ([], []))
            places.append(place)
            given.append(parts)
    pairs += [(place, name, parts, False) for place, name, parts in _other_pairs(text)]

    def resolved(parts: list[Part], place: int, steps: int = MAX_STEPS) -> list[tuple[int, int]] | None:
        """The literals a value is made of; a name stands for what it was given last before, else first after."""
        out: list[tuple[int, int]] = []
        for part in parts:
            if isinstance(part, str):
                if part not in known or not steps:
                    return None
                places, given = known[part]
                k = bisect.bisect_left(places, place) - 1
                if k < 0:
                    k = bisect.bisect_right(places, place)
                part_spans = resolved(given[k], places[k], steps - 1) if k < len(places) else None
                if not part_spans or len(out) + len(part_spans) > MAX_PARTS:
                    return None
                out += part_spans
            else:
                out.append(part)
        return out

    best: dict[tuple[int, int], tuple[float, str]] = {}
    for place, name, parts, bare in pairs:
        weight = name_weight(name)
        if weight < 2.0:
            continue
        spans = resolved(parts, place)
        if not spans and bare and any(c.isdigit() for c in parts[0]):
            # no name that the text knows: a literal without quotes
            at = text.index(parts[0], place + len(name))
            spans = [(at, at + len(parts[0]))]
        if not spans:
            continue
        value = "".join(text[a:b] for a, b in spans)
        score = weight + literal_weight(value)
        if score >= MIN_SCORE:
            for span in spans:
                if span[0] < span[1] and (span not in best or score > best[span][0]):
                    best[span] = (score, name)
    return [(a, b, name, score) for (a, b), (score, name) in sorted(best.items())]


def scan_text(text: str) -> list[dict]:
    spans = [{"kind": k, "start": a, "end": b, "name": None, "score": None} for k, a, b in base_spans(text)]
    if any(c in text for c in ":=(<"):
        spans += [
            {"kind": "literal", "start": a, "end": b, "name": name, "score": score}
            for a, b, name, score in assigned_literals(text)
        ]
    return sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"]))


def scan_secrets(df: DataFrame, text_col: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``df`` with ``secret_spans``: array of (kind, start, end, name, score), ordered by place.

    Offsets are code points, end exclusive. Kinds ``assign``, ``access`` and ``hex`` are the base patterns, ``literal``
    what the lexer adds with the name and score that decided it. A null or empty text has no spans; a text of any
    length is read whole; repeated rows are judged alike. A column named ``secret_spans`` is replaced. ``carry`` names
    the columns to return (all by default). No row meets another one, so nothing is shuffled.
    """
    bounded_batches(df.sparkSession)
    base = df.drop("secret_spans")
    carried = [c for c in (base.columns if carry is None else carry) if c != "secret_spans"]
    base = base.select(*dict.fromkeys([*[f"`{c}`" for c in carried], f"`{text_col}`"]))
    names = base.columns
    kinds = base.select(*[f"`{c}`" for c in carried]).schema.fields
    spans_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t or "") for t in batch.column(names.index(text_col)).to_pylist()]
            kept = [batch.column(names.index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, spans_type)], [*carried, "secret_spans"])

    return base.mapInArrow(scanned, T.StructType([*kinds, *T._parse_datatype_string(f"secret_spans {SPAN}").fields]))


def spans_text(spans: str, kinds: Sequence[str] | None = None):
    """``kind:start:end`` of the spans, comma-joined; only of the given kinds if any."""
    chosen = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
