"""Personal data by anchors: an Aho-Corasick automaton finds them, local parsers grow the spans.

The automaton looks for at-signs, plus signs, digits, schemes and identifier cues in one pass over
the whole text. At each anchor a small deterministic parser expands to the left and right until the
span's boundary and validates it (octets, Luhn, digit counts, IBAN check digits). Each kind keeps
a cursor, so its spans never overlap and begin as far left as they can; the spans of the four base
kinds are exactly the leftmost non-overlapping matches of their patterns.

Base kinds: email, ip, card, phone. Added by the method: ``iban`` (after a cue or not, valid check
digits), ``account`` (a cue such as "account no." and 6 to 18 digits), ``login`` (user information
in front of the host of an address with a scheme) and ``address`` (house number, capitalised street
name and street word).

Null counts as an empty text and has no spans. Rows are independent, so repeated rows give repeated
results and an empty table gives an empty one; other columns are ignored. The work is linear in
the text's length.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from pickwise.llm.tables import span_columns, texts
from pickwise.llm.words import row_blocks

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "account", "login", "address"]
FOUND = "array<struct<kind:string,start:long,end:long,base:boolean>>"

# Cues of account numbers and street words.
ACCOUNT_CUES = ["account", "acct", "konto", "compte", "cuenta"]
STREET_WORDS = ["Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Square"]

_LOCAL = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?: ?(?:no|nr|number)\b\.?)? ?[:#]? ?([0-9]{6,18})(?![0-9])", re.I)
_LOGIN = re.compile(r"([A-Za-z0-9._~%!$&'*+,;=-]+:[A-Za-z0-9._~%!$&'*+,;=-]+)@[A-Za-z0-9]")
_HOUSE = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,5}[a-z]?(?: [A-Z][a-z]{1,19}){1,4} \Z")
#: Characters to the left of a street word that its parser can need: 5 words of 20 and a number.
_HOUSE_REACH = 120


@functools.lru_cache(1)
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("+", ("plus", 1))
    automaton.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            automaton.add_word(form, ("account", len(form)))
    for word in STREET_WORDS:
        automaton.add_word(f" {word}", ("street", len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        x = int(c) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _valid_iban(span: str) -> bool:
    plain = span.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """Spans (kind, start, end, base) by start, then in the order of ``KINDS``."""
    out: list[tuple[int, int, int]] = []
    at_floor = ip_next = card_next = run_end = iban_next = 0
    for last, (kind, size) in _anchors().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= ip_next:
                match = _IP.match(text, at)
                if match:
                    ip_next = match.end()
                    if all(map(_octet, match.group().split("."))):
                        out.append((at, 1, ip_next))
                else:
                    ip_next = _DIGITS.match(text, at).end()
            if at >= card_next:
                match = _CARD.match(text, at)
                card_next = match.end() if match else at + 1
                if match:
                    digits = match.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, 2, card_next))
            if at >= run_end:
                run_end = _DIGITS.match(text, at).end()
                start = at - 2
                if start >= iban_next and not (start and text[start - 1].isalnum()):
                    match = _IBAN.match(text, start)
                    if match and _valid_iban(match.group()):
                        out.append((start, 4, iban_next := match.end()))
        elif kind == "at":
            run = text[at_floor:at]
            local = len(run) - len(run.rstrip(_LOCAL))
            at_floor = at + 1
            if local and (match := _DOMAIN.match(text, at + 1)):
                out.append((at - local, 0, at_floor := match.end()))
        elif kind == "plus":
            match = _PHONE.match(text, at)
            if match and 10 <= sum(c.isdigit() for c in match.group()) <= 15:
                out.append((at, 3, match.end()))
        elif kind == "account":
            if not (at and text[at - 1].isalpha()) and (match := _ACCOUNT.match(text, last + 1)):
                out.append((match.start(1), 5, match.end(1)))
        elif kind == "scheme":
            if match := _LOGIN.match(text, last + 1):
                out.append((match.start(1), 6, match.end(1)))
        elif not text[last + 1 : last + 2].isalnum():
            left = max(0, at - _HOUSE_REACH)
            if match := _HOUSE.search(text[left:at]):
                out.append((left + match.start(), 7, last + 1))
    out.sort()
    return [(KINDS[k], start, end, k < len(BASE_KINDS)) for start, k, end in out]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, the spans of each whole text in code points, end exclusive."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )
    names = ["kind", "start", "end", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "text"):
            found = [
                [dict(zip(names, x)) for x in find(text or "")]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "found"]
            )

    return texts(docs).mapInArrow(run, f"doc_id {kind}, found {FOUND}")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, and the spans as text."""
    return found.select("doc_id", *span_columns(BASE_KINDS))
