"""Candidates for secrets: base findings, and all runs of token characters that base spans do not cover."""

from __future__ import annotations

import re

#: Shortest run that is a candidate by its length alone.
LONG_TOKEN = 16

# Names whose assignments are base findings.
_NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]
_SEPARATOR = re.compile("[:=]")
_VALUE = re.compile(r" *[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
_HEX = re.compile("[0-9a-f]{16,}")


def _name_before(left: str) -> int:
    """Length of the end of ``left`` that is a secret name, a quote and spaces; 0 if it is not."""
    cut = left.rstrip(" ")
    if cut[-1:] in ("'", '"'):
        cut = cut[:-1]
    for name in _NAMES:
        tail = cut[-len(name) :]
        if tail.isascii() and tail.lower() == name:
            return len(left) - len(cut) + len(name)
    return 0


def candidates(text: str) -> list[tuple[int, int, str, int]]:
    """Spans (start, order of kind, kind, end) of all base findings and other candidates."""
    out = []
    after = last = 0
    for found in _SEPARATOR.finditer(text):
        at = found.start()
        if at < after:
            last = at + 1
            continue
        if size := _name_before(text[max(after, last) : at]):
            value = _VALUE.match(text, at + 1)
            if value:
                after = value.end()
                if after - value.start(1) >= 12:
                    out.append((at - size, 0, "assign", after))
        last = at + 1
    for found in _ACCESS.finditer(text):
        out.append((found.start(), 1, "access", found.end()))
    runs = []
    for run in _RUN.finditer(text):
        start, end = run.span()
        for found in _HEX.finditer(text, start, end):
            out.append((found.start(), 2, "hex", found.end()))
        start += len(run.group()) - len(run.group().lstrip("=.-"))
        end -= len(run.group()) - len(run.group().rstrip(".-"))
        if end - start >= LONG_TOKEN:
            runs.append((start, end))
    out.sort()
    # A long run that base spans cover entirely is that finding, not another one.
    base, n = [], 0
    for start, _, _, end in out:
        if base and start <= base[-1][1]:
            base[-1] = (base[-1][0], max(end, base[-1][1]))
        else:
            base.append((start, end))
    for start, end in runs:
        while n < len(base) and base[n][1] <= start:
            n += 1
        if n == len(base) or base[n][0] > start or base[n][1] < end:
            out.append((start, 3, "token", end))
    out.sort()
    return out
