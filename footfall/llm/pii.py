"""Personal data and secrets: expressions propose spans, checksums or the spread of characters confirm them, nearby words move the score."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from footfall.llm.common import map_columns

#: Order of kinds that start at the same place; the first four are those of the contract.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone", "secret")
RANK = {kind: i for i, kind in enumerate(KINDS)}

#: Score of a confirmed span before its surroundings are looked at, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.3, "secret": 0.4}
CONTEXT_BONUS = 0.3
THRESHOLD = 0.6
#: Code points before a span in which context words count.
CONTEXT_WIDTH = 40
CONTEXT = {
    "email": re.compile(r"mail|contact|kontakt|correo|courriel|courrier", re.I),
    "ip": re.compile(r"\bip\b|address|adresse|dirección|host|server|serveur|servidor|client", re.I),
    "card": re.compile(r"card|carte|karte|tarjeta|visa|credit|crédit|kredit", re.I),
    "phone": re.compile(r"phone|tel|tél|call|appel|anruf|mobil|móvil|handy|fax|llam", re.I),
    "iban": re.compile(r"iban|account|konto|compte|cuenta", re.I),
    "ssn": re.compile(r"ssn|social|security|sozial|sécurité|seguridad", re.I),
    "local_phone": re.compile(r"phone|\btel\b|\btél\b|telef|téléf|\bcall\b|\bappel|\banruf|mobil|móvil|\bfax\b|\bllam", re.I),
    "secret": re.compile(
        r"token|secret|passw|passphrase|api.?key|access.?key|private.?key|credential|\bpwd\b|\bauth|bearer"
        r"|jeton|mot de passe|clé|schlüssel|kennwort|contraseña|clave",
        re.I,
    ),
}

# Maximal chains, each matched in one pass over the text without trying a place twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")

#: Long runs of the characters that keys and tokens are written in, and how long and how mixed a secret's run is.
_RUN = re.compile(r"[A-Za-z0-9_+/-]{20,}+={0,2}")
SECRET_LENGTH, SECRET_BITS = 256, 3.0
#: Beginnings of keys of well-known services, which say by themselves what they are.
_KEY_START = re.compile(r"AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|xoxb-|xoxp-|AIza|eyJ")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_KEY_BLOCK_END = re.compile(r"-----END [A-Z ]{0,30}PRIVATE KEY-----")

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Of a chain of dotted numbers, each four in turn."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts = chain.group().split(".")
        start = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _DIGITS.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, match.group())) <= 15:
                yield match.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for match in _IBAN.finditer(text):
        compact = match.group().replace(" ", "")
        if 15 <= len(compact) <= 34 and mod_97(compact):
            yield match.span()


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for match in _SSN.finditer(text):
        area, group, serial = match.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield match.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _LOCAL_PHONE.finditer(text):
        yield match.span()


def bits_per_character(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    """Blocks of private keys; elsewhere runs of letters and digits too mixed for words or numbers."""
    blocks, until = [], 0
    if "PRIVATE KEY-----" in text:
        for begin in _KEY_BLOCK.finditer(text):
            if begin.start() < until:
                continue
            end = _KEY_BLOCK_END.search(text, begin.end())
            if end is None:
                break
            until = end.end()
            blocks.append((begin.start(), until))
    yield from blocks
    for match in _RUN.finditer(text):
        run = match.group()
        if len(run) <= SECRET_LENGTH and _ANY_DIGIT.search(run) and _ANY_LETTER.search(run) and bits_per_character(run) >= SECRET_BITS:
            yield match.span()


BASE = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}
ADDED = {"iban": _ibans, "ssn": _ssns, "local_phone": _local_phones, "secret": _secrets}
_ANY_DIGIT = re.compile("[0-9]")
_ANY_LETTER = re.compile("[A-Za-z]")


def find_spans(text: str) -> list[Span]:
    """The spans of the four base kinds, whatever their score, and those of the added kinds that
    reach the threshold and touch no other span, by start and kind."""
    digits = _ANY_DIGIT.search(text) is not None
    found = []
    for kind, proposed in BASE.items():
        if digits or kind == "email":
            found += [_scored(text, kind, *span) for span in proposed(text)]
    if digits:
        taken = sorted((s.start, s.end) for s in found)
        for kind, proposed in ADDED.items():
            for start, end in proposed(text):
                span = _scored(text, kind, start, end)
                if span.score >= THRESHOLD and all(end <= a or b <= start for a, b in taken):
                    found.append(span)
                    taken.append((start, end))
    return sorted(found, key=lambda s: (s.start, RANK[s.kind]))


def _scored(text: str, kind: str, start: int, end: int) -> Span:
    near = CONTEXT[kind].search(text[max(0, start - CONTEXT_WIDTH) : start])
    shaped = kind == "secret" and (_KEY_START.match(text, start) or text.startswith("-----BEGIN", start))
    return Span(kind, start, end, round(min(1.0, SCORES[kind] + CONTEXT_BONUS * (bool(near) + bool(shaped))), 2))


def redacted(text: str, spans: list[Span]) -> str:
    """Each span as ``[KIND]``; of overlapping spans, the stretch they cover as the first one's."""
    pieces, at = [], 0
    for span in spans:
        if span.start >= at:
            pieces += [text[at : span.start], f"[{span.kind.upper()}]"]
        at = max(at, span.end)
    return "".join(pieces) + text[at:]


def detect_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans, redacted text: one row per row of ``docs``; nothing is shuffled.

    Offsets are code points, the end exclusive. A null text is an empty one, without spans. Ids
    pass through, null or repeated; other columns are ignored; an empty table gives no rows.
    """

    def start():
        def step(ids, texts):
            found = [find_spans(text or "") for text in texts]
            return ids, [[s._asdict() for s in spans] for spans in found], [redacted(t or "", s) for t, s in zip(texts, found)]

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(chosen, f"doc_id {kind}, spans {SPANS}, redacted string", start)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The table with personal data in ``text`` replaced; a null text stays null, all rows stay."""
    out = docs.withColumn("text", _redact(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


@F.pandas_udf(StringType())
def _redact(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else redacted(text, find_spans(text)))
