"""Personal data by weak supervision.

One pass over the texts marks candidate spans: the base patterns, and looser shapes (numbers, account numbers, names).
Labelers that look at shape, check digits, word lists and context vote for or against each candidate. Expectation
maximisation over the counts of all vote patterns estimates how reliable every labeler is, and its posteriors train a
logistic classifier of spans on features of the span itself. Base spans always stay; a further candidate is returned
when the classifier accepts it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches
from cohortloom.runtime import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "number", "name")
SPAN = "array<struct<kind:string,start:long,end:long,base:boolean,votes:int,bits:int>>"
N_LABELERS = 6
N_BITS = 10

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match cannot begin inside a run of digits whose beginning does not match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?<![\w.+\-/])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![\w/]|[.-][0-9])")
_NAME = re.compile(r"(?<!\w)[A-Z][a-zà-öø-ÿ]{1,20}(?:[\x20-][A-Z][a-zà-öø-ÿ]{1,20}){1,2}(?!\w)")

GIVEN_NAMES = frozenset(
    "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth "
    "barbara susan jessica sarah karen anna maria peter paul hans klaus jürgen wolfgang ursula monika sabine pierre "
    "jean marie claire françois nathalie juan josé carlos carmen antonio manuel laura marta lucía pablo".split()
)
TITLES = frozenset("mr mrs ms dr prof herr frau madame monsieur señor señora sr sra".split())
CUES = re.compile(
    r"(?i)\b(?:tel|phone|mobile|cell|call|fax|contact|ssn|social security|passport|account|iban|card|name|"
    r"patient|born|mr|mrs|ms|dr|prof|telefon|konto|herr|frau|téléphone|monsieur|madame|teléfono|señora?)\b[^\n]{0,12}\Z"
)
COUNTER_CUES = re.compile(
    r"(?i)(?:\b(?:isbn|issn|version|order|invoice|page|vol|chapter|figure|id|no|nr|rev|build|line|year|item|sku|doi)"
    r"\b|[$€£#=])[^\n\w]{0,6}\Z"
)
UNITS = re.compile(r"(?i)\A\s?(?:%|€|\$|km|kg|mb|gb|ms|px|usd|eur|rows|tokens|bytes|times)\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def account_check(value: str) -> bool:
    """The remainder rule of international account numbers."""
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Address spans. Every match holds one @, so the search goes from @ to @ and extends to both sides."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            floor = m.end()
            found.append((start, floor))
        else:
            floor = max(floor, start)
        at = text.find("@", max(at + 1, floor))
    return found


def _small(part: str) -> bool:
    plain = part.lstrip("0")
    return len(plain) <= 3 and int(plain or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base patterns, by kind as listed, then place; failing matches are dropped."""
    found = [("email", a, b) for a, b in emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _free(text_spans: list[tuple[str, int, int]]):
    """Whether a span overlaps none of the given ones."""
    taken = sorted((a, b) for _, a, b in text_spans)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)

    def free(a: int, b: int) -> bool:
        k = int(np.searchsorted(starts, b))
        return k == 0 or int(ends[k - 1]) <= a

    return free


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Base spans and looser shapes that do not overlap them: (kind, start, end, base)."""
    base = base_spans(text)
    free = _free(base)
    more: list[tuple[str, int, int]] = []
    for kind, pattern in (("account", _ACCOUNT), ("number", _NUMBER), ("name", _NAME)):
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == "name" and not (_named(m[0]) or CUES.search(text, max(0, a - 40), a)):
                continue
            if free(a, b) and not (more and any(a < e and s < b for _, s, e in more[-3:])):
                more.append((kind, a, b))
    return [(k, a, b, True) for k, a, b in base] + [(k, a, b, False) for k, a, b in more]


def _named(value: str) -> bool:
    return any(w.lower() in GIVEN_NAMES or w.lower() in TITLES for w in re.split(r"[\x20-]", value))


def _votes(kind: str, value: str, before: str, after: str) -> list[int]:
    """One vote of each labeler: 1 for personal data, -1 against, 0 for no opinion."""
    digits = re.sub(r"\D", "", value)
    shape = {"email": 1, "ip": 1, "phone": 1 if value[2:3] in " (" or "-" in value else 0}.get(kind, 0)
    if kind == "number":
        local = re.search(r"\A\(?\d{3}\)?[\x20.-]\d{3}[\x20.-]\d{4}\Z|\A\d{3}-\d{2}-\d{4}\Z", value)
        shape = 1 if local else -1 if re.search(r"\A(?:19|20)\d\d[-.]|[.-](?:19|20)\d\d\Z", value) else 0
    check = 0
    if kind == "card" or kind == "number" and len(digits) >= 12:
        check = 1 if luhn(digits) else -1
    elif kind == "account":
        check = 1 if account_check(value) else -1
    listed = (1 if _named(value) else -1) if kind == "name" else 0
    cue = 1 if CUES.search(before) else 0
    against = -1 if COUNTER_CUES.search(before) or UNITS.search(after) else 0
    plain = 0
    if digits:
        plain = -1 if len(set(digits)) <= 2 or digits in "01234567890123456789" else 1 if len(set(digits)) >= 5 else 0
    return [shape, check, listed, cue, against, plain]


def _bits(kind: str, value: str, before: str, after: str) -> int:
    digits = sum(c.isdigit() for c in value)
    tests = (
        digits >= 9,
        digits >= 12,
        bool(re.search(r"[\x20.-]", value)),
        "(" in value,
        before[-1:].isspace() or not before,
        bool(re.search(r"[:=]\s*\Z", before)),
        after[:1] in ",;.\n" or not after,
        bool(CUES.search(before)),
        bool(COUNTER_CUES.search(before)),
        value[:1].isupper() and len(value.split()) >= 2,
    )
    return sum(1 << i for i, t in enumerate(tests) if t)


def label_text(text: str) -> list[dict]:
    out = []
    for kind, a, b, base in candidates(text):
        value, before, after = text[a:b], text[max(0, a - 40) : a], text[b : b + 12]
        code = 0
        for vote in _votes(kind, value, before, after):
            code = code * 3 + vote + 1
        bits = _bits(kind, value, before, after)
        out.append({"kind": kind, "start": a, "end": b, "base": base, "votes": code, "bits": bits})
    return sorted(out, key=lambda s: (KINDS.index(s["kind"]), s["start"]))


def _vote_matrix(codes: np.ndarray) -> np.ndarray:
    return np.stack([(codes // 3 ** (N_LABELERS - 1 - k)) % 3 for k in range(N_LABELERS)], axis=1)


@dataclass(frozen=True)
class LabelModel:
    """Per labeler the chances of its three votes given no (row 0) and yes (row 1), and the share of yes per kind."""

    chances: np.ndarray
    prior: dict[str, float]

    def posterior(self, kinds: Sequence[str], codes: np.ndarray) -> np.ndarray:
        votes = _vote_matrix(codes)
        logs = np.log(self.chances)
        prior = np.array([self.prior[k] for k in kinds])
        score = np.log(prior) - np.log1p(-prior)
        for k in range(N_LABELERS):
            score = score + logs[k, 1, votes[:, k]] - logs[k, 0, votes[:, k]]
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def fit_label_model(kinds: Sequence[str], codes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation maximisation over vote patterns. It starts from the sign of the votes' sum."""
    votes = _vote_matrix(codes)
    kinds = list(kinds)
    yes = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(axis=1)))
    model = LabelModel(np.full((N_LABELERS, 2, 3), 1 / 3), dict.fromkeys(KINDS, 0.5))
    for _ in range(rounds):
        chances = np.empty((N_LABELERS, 2, 3))
        for k in range(N_LABELERS):
            for y, share in enumerate((1 - yes, yes)):
                got = np.bincount(votes[:, k], counts * share, 3) + 1.0
                chances[k, y] = got / got.sum()
        prior = dict.fromkeys(KINDS, 0.5)
        for kind in set(kinds):
            at = np.array([x == kind for x in kinds])
            prior[kind] = float((counts[at] @ yes[at] + 1) / (counts[at].sum() + 2))
        model = LabelModel(chances, prior)
        new = model.posterior(kinds, codes)
        if np.abs(new - yes).max() < 1e-6:
            break
        yes = new
    return model


def fit_span_classifier(kinds: Sequence[str], bits: np.ndarray, yes: np.ndarray, no: np.ndarray) -> dict[str, list[float]]:
    """Weighted logistic regression with a small ridge, by Newton steps; one intercept per kind, one weight per bit."""
    x = np.array([[k == kind for kind in KINDS] + [b >> i & 1 for i in range(N_BITS)] for k, b in zip(kinds, bits)], float)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (yes - (yes + no) * p) - w
        curve = (x * ((yes + no) * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return {"kinds": w[: len(KINDS)].tolist(), "bits": w[len(KINDS) :].tolist()}


def candidate_spans(df: DataFrame, text_col: str, carry: Sequence[str]) -> DataFrame:
    """The carried columns and ``__found``: all candidates of the text with votes and features."""
    base = df.select(*dict.fromkeys([*[f"`{c}`" for c in carry], f"`{text_col}`"]))
    names = base.columns
    kinds = base.select(*[f"`{c}`" for c in carry]).schema.fields
    kind_of = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.int32()), ("bits", pa.int32())]
        )
    )

    def labeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [label_text(t or "") for t in batch.column(names.index(text_col)).to_pylist()]
            kept = [batch.column(names.index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind_of)], [*carry, "__found"])

    return base.mapInArrow(labeled, T.StructType([*kinds, *T._parse_datatype_string(f"__found {SPAN}").fields]))


def scan_personal_data(df: DataFrame, text_col: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with ``pii_spans``: array of (kind, start, end, base, probability), by kind as listed, then place.

    Offsets are code points, end exclusive. The candidates are written to the shared folder once; vote patterns are
    counted over all rows by a grouped aggregation, and only those counts (at most 7 kinds x 729 patterns, and 7 kinds
    x 1,024 feature sets) reach the driver, where both models are fitted. No text is shuffled.

    A null or empty text has no spans; texts are read whole; repeated rows are judged alike; without any candidate no
    model is fitted. A column named ``pii_spans`` is replaced. ``carry`` names the columns to return (all by default).
    """
    bounded_batches(df.sparkSession)
    base = df.drop("pii_spans")
    carried = [c for c in (base.columns if carry is None else carry) if c != "pii_spans"]
    found = materialize(candidate_spans(base, text_col, carried), "candidates")
    each = found.select(F.explode("__found").alias("s")).select("s.kind", "s.votes", "s.bits")
    counted = materialize(each.groupBy("kind", "votes", "bits").agg(F.count(F.lit(1)).alias("n")), "votes")
    patterns = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).toPandas()
    weights = {"kinds": [0.0] * len(KINDS), "bits": [0.0] * N_BITS}
    if len(patterns):
        codes = patterns["votes"].to_numpy(np.int64)
        model = fit_label_model(patterns["kind"].tolist(), codes, patterns["n"].to_numpy(float))
        patterns["yes"] = model.posterior(patterns["kind"].tolist(), codes)
        truth = df.sparkSession.createDataFrame(
            [(r.kind, int(r.votes), float(r.yes)) for r in patterns.itertuples()], "kind string, votes int, yes double"
        )
        sums = (
            counted.join(F.broadcast(truth), ["kind", "votes"])
            .groupBy("kind", "bits")
            .agg(F.sum(F.col("n") * F.col("yes")).alias("yes"), F.sum(F.col("n") * (1 - F.col("yes"))).alias("no"))
            .orderBy("kind", "bits")
            .toPandas()
        )
        weights = fit_span_classifier(
            sums["kind"].tolist(), sums["bits"].to_numpy(np.int64), sums["yes"].to_numpy(), sums["no"].to_numpy()
        )
    scored = F.transform(
        "__found",
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["base"].alias("base"),
            _probability(s, weights).alias("probability"),
        ),
    )
    kept = F.filter(scored, lambda s: s["base"] | (s["probability"] >= 0.5))
    return found.select(*[f"`{c}`" for c in carried], kept.alias("pii_spans"))


def _probability(span: Column, weights: dict[str, list[float]]) -> Column:
    score = F.lit(0.0)
    for kind, w in zip(KINDS, weights["kinds"]):
        score = score + F.when(span["kind"] == kind, F.lit(w)).otherwise(F.lit(0.0))
    for i, w in enumerate(weights["bits"]):
        score = score + F.shiftright(span["bits"], i).bitwiseAND(F.lit(1)) * F.lit(w)
    return 1 / (1 + F.exp(-score))
