"""Personal data by weak supervision.

Patterns propose spans, and labelers (format, checksum, gazetteer, boundary, context) vote on
each. Expectation maximisation over the counted vote patterns of the corpus estimates how far a labeler
can be relied on; its posterior labels train the logistic classifier that decides on every span
the base patterns don't settle.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.passes import add_columns
from panelwright.scale import written

KINDS = ("email", "ip", "card", "phone", "id")
BASE = KINDS[:4]
LEAST = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its first digit only, so that long runs take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Looser forms that only the classifier can accept.
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:"
                    r"\s?(?:\[at\]|\(at\)|\{at\})\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\[dot\]|\(dot\)|\{dot\}|\.|\sdot\s)\s?[A-Za-z0-9-]{1,63}){1,4}"
                    r"|\sat\s[A-Za-z0-9-]{1,63}(?:\sdot\s[A-Za-z0-9-]{1,63}){1,4})")
_LOCAL_PHONE = re.compile(r"(?:\+[0-9]{1,3}[\x20.-]?|(?<![0-9+.-]))\(?[0-9]{2,5}\)?[\x20./-]{1,2}[0-9]{3,4}[\x20./-][0-9]{3,5}(?![0-9])")
_LOCAL_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])")
_IDS = re.compile(r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7})(?![0-9A-Za-z-])")

# Gazetteers and context words of the labelers.
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es uk eu us ch at it nl".split())
ID_COUNTRIES = frozenset("AT BE CH DE DK ES FR GB IE IT LU NL NO PL PT SE".split())
FOR = {
    "email": "mail email e-mail correo courriel contact kontakt write",
    "ip": "ip host server address adresse dirección client login",
    "card": "card visa mastercard credit karte kreditkarte tarjeta carte payment",
    "phone": "phone tel telephone call fax mobile telefon teléfono téléphone handy",
    "id": "ssn social security iban account konto cuenta compte",
}
AGAINST = "version release section chapter page figure table isbn issn order invoice build rfc article ratio"
_FOR = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v.split())) + r")\b", re.I) for k, v in FOR.items()}
_AGAINST = re.compile(r"\b(?:" + "|".join(AGAINST.split()) + r")\b", re.I)
CONTEXT = 40
LABELERS = ("format", "checksum", "gazetteer", "boundary", "context_for", "context_against")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def _fits(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in found.split(".")))
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """All proposed spans ``(kind, start, end, base)``; base ones first, the others never overlap them."""
    spans = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    loose = [("email", m.start(), m.end()) for m in _SPELT.finditer(text)] if any(x in text for x in ("dot", "at]", "at)", "at}")) else []
    if _DIGIT.search(text):
        spans += [(k, m.start(), m.end()) for k, p in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)) for m in p.finditer(text)]
        loose += [("phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
        loose += [("card", m.start(), m.end()) for m in _LOCAL_CARD.finditer(text)]
        loose += [("id", m.start(), m.end()) for m in _IDS.finditer(text)]
    base = [x for x in spans if _fits(x[0], text[x[1]:x[2]])]
    sure = set(base)
    # a run of digits too short for a card, or longer than anything of its kind, says nothing
    other = [x for x in spans if x not in sure and (13 if x[0] == "card" else 0) <= x[2] - x[1] <= 40] + loose
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else None

    def free(x: tuple[str, int, int]) -> bool:
        before = int(np.searchsorted(starts, x[2]))
        return not before or reach[before - 1] <= x[1]
    return [(*x, True) for x in base] + [(*x, False) for x in dict.fromkeys(other) if free(x)]


def votes(text: str, kind: str, start: int, end: int, base: bool) -> list[int]:
    """What each labeler says: 1 for, -1 against, 0 nothing."""
    found = text[start:end]
    digits = re.sub(r"[^0-9]", "", found)
    format_ = 1 if base else -1 if kind in ("ip", "card") or kind == "phone" and found[0] == "+" else 0
    checksum = gazetteer = 0
    if kind == "email":
        checksum = 1 if len(found) <= 254 and ".." not in found else -1
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", found.rstrip(")]}"))[-1].lower() in TOP_DOMAINS else -1
    elif kind == "ip":
        checksum = 1 if base else -1
        gazetteer = -1 if found.split(".")[0] in ("0", "127", "255") else 0
    elif kind == "card":
        checksum = 1 if luhn(digits) and len(digits) >= 13 else -1
        gazetteer = 1 if digits[0] in "3456" and len(set(digits)) > 3 else -1
    elif kind == "phone":
        checksum = 1 if 9 <= len(digits) <= 13 else -1
        gazetteer = 1 if found[0] in "+(" else 0
    else:
        checksum = -1 if digits[:3] in ("000", "666") else 1
        gazetteer = 0 if found[0].isdigit() else 1 if found[:2] in ID_COUNTRIES else -1
    around = (text[start - 1:start] or " ") + (text[end:end + 1] or " ")
    boundary = -1 if any(c.isalnum() or c in "_=/#" for c in around) else 1
    before = text[max(0, start - CONTEXT):start]
    return [format_, checksum, gazetteer, boundary,
            1 if _FOR[kind].search(before) else 0, -1 if _AGAINST.search(before) else 0]


def _code(kind: str, said: list[int], length: int, base: bool) -> int:
    """One number for kind, votes, length class and base: what the counts of the corpus are kept by."""
    code = KINDS.index(kind)
    for v in said:
        code = code * 3 + v + 1
    return (code * 4 + min(3, length // 8)) * 2 + base


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    base, rest = codes % 2, codes // 2
    length, rest = rest % 4, rest // 4
    said = np.zeros((len(codes), len(LABELERS)), dtype=int)
    for k in reversed(range(len(LABELERS))):
        said[:, k], rest = rest % 3 - 1, rest // 3
    return rest, said, length, base


def reliabilities(kind: np.ndarray, said: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Accuracy of each labeler where it votes, and the posterior of each vote pattern, by expectation maximisation."""
    right, prior = np.full(said.shape[1], 0.8), np.full(len(KINDS), 0.5)
    post = np.full(len(n), 0.5)
    for _ in range(rounds):
        odds = np.log(prior[kind] / (1 - prior[kind])) + said @ np.log(right / (1 - right))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        for k in range(said.shape[1]):
            agree = n * np.where(said[:, k] > 0, post, 1 - post) * (said[:, k] != 0)
            voted = n * (said[:, k] != 0)
            right[k] = np.clip((agree.sum() + 8) / (voted.sum() + 10), 0.55, 0.99)
        for k in range(len(KINDS)):
            own = kind == k
            prior[k] = (n[own] @ post[own] + 1) / (n[own].sum() + 2)
        prior = np.clip(prior, 0.02, 0.98)
    return right, post


def _design(kind: np.ndarray, said: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.concatenate([np.eye(len(KINDS))[kind], said > 0, said < 0, np.eye(4)[length]], axis=1).astype(float)


def train(counts: dict[int, int]) -> dict:
    """From the number of spans per pattern to the span classifier: ``reliability`` by labeler, ``weights``.

    The number of patterns is bounded by kinds, votes and length classes (29,160), whatever the corpus.
    """
    if not counts:
        return {"reliability": dict.fromkeys(LABELERS, 0.8), "weights": None}
    codes = np.array(sorted(counts))
    n = np.array([counts[c] for c in codes.tolist()], dtype=float)
    kind, said, length, _ = _decode(codes)
    right, post = reliabilities(kind, said, n)
    x, weight = _design(kind, said, length), np.sqrt(n / n.mean())  # rare patterns keep a say
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(beta))
        step = np.linalg.solve(curve, x.T @ (weight * (post - p)) - 0.01 * beta)
        beta = beta + np.clip(step, -2, 2)
    return {"reliability": dict(zip(LABELERS, right.round(4).tolist(), strict=True)), "weights": beta}


def accepted(model: dict, codes: list[int]) -> dict[int, float]:
    """Score of each pattern."""
    if model["weights"] is None or not codes:
        return {}
    kind, said, length, _ = _decode(np.array(codes))
    scores = 1 / (1 + np.exp(-np.clip(_design(kind, said, length) @ model["weights"], -30, 30)))
    return dict(zip(codes, scores.tolist(), strict=True))


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text`` but with ``candidates``: kind, start, end and pattern of every span, one after the other."""
    def make():
        def compute(texts: list[bytes]) -> list[list]:
            out = []
            for t in texts:
                text = t.decode("utf-8", "replace")
                row: list[int] = []
                for kind, s, e, base in candidates(text):
                    row += [KINDS.index(kind), s, e, _code(kind, votes(text, kind, s, e, base), e - s, base)]
                out.append(row)
            return [out]
        return compute
    return add_columns(docs, "text", "candidates array<bigint>", make, drop=("text",))


def find_private(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, base counts ``n_email, n_ip, n_card, n_phone``, ``base_sha256``, ``spans, n_added``.

    Base spans always stay; the classifier adds others that score at least ``LEAST``, the best first and none that
    overlaps. Places are code points, the end is exclusive. NULL and empty texts have no spans; bytes
    that aren't UTF-8 count as replacement characters. Rows that repeat are each searched; further columns don't matter; an
    empty table gives no rows.
    """
    found = written(detect(docs.select("doc_id", "text")))
    places = F.transform(F.sequence(F.lit(3), F.size("candidates") - 1, F.lit(4)), lambda i: F.get("candidates", i))
    counted = found.where(F.size("candidates") > 0).select(F.explode(places).alias("code")).groupBy("code").count()
    counts = {r[0]: r[1] for r in counted.collect()}  # bounded, see train
    scores = accepted(train(counts), sorted(counts))

    def run(batches):
        for batch in batches:
            rows = [_spans(x, scores) for x in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "candidates").mapInArrow(
        run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def _spans(flat: list[int], scores: dict[int, float]) -> tuple:
    rows = [tuple(flat[i:i + 4]) for i in range(0, len(flat), 4)]
    base = sorted(r[:3] for r in rows if r[3] % 2)
    added: list[tuple[int, int, int]] = []
    for score, s, e, k in sorted((-scores.get(c, 0.0), s, e, k) for k, s, e, c in rows if not c % 2):
        if -score >= LEAST and all(e <= x[1] or x[2] <= s for x in added):
            added.append((k, s, e))

    def text(spans: list) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
    n = [sum(1 for b in base if b[0] == k) for k in range(len(BASE))]
    return (*n, hashlib.sha256(text(base).encode()).hexdigest(), text(sorted([*base, *added])), len(added))
