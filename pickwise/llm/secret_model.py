"""A small character convolutional network in numpy, and the labelled findings it is trained on.

A finding is a span and its surroundings. The network slides over the whole span in windows of
``INSIDE`` characters, ``STRIDE`` apart, and the finding's logit is the largest of them. In a window
it sees these characters, ``BEFORE`` in front of them and ``AFTER`` behind them, as character codes
with two flags (upper case, inside the window). One convolution, maximum and mean over positions, one hidden
layer, one logit. The logit is calibrated by Platt scaling on findings set aside, and the threshold
is the largest one, but at most one half, that still finds ``RECALL`` of the secrets among further
findings set aside, as far as candidates cover them: a secret is found if such a candidate in its text
scores so much.

The labelled findings are a table made from a rule and a seed: tokens of common credential formats
against identifiers, paths, digests of files, dates and words that look alike. Some secrets stand
late in a long run, behind a path, an address or a key. Training takes several seconds on the driver, has a fixed size, and gives the same weights on every run.
"""

from __future__ import annotations

import base64
import functools
import itertools
import random
from collections.abc import Iterable

import numpy as np

from pickwise.llm.secret_spans import candidates

BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH = BEFORE + INSIDE + AFTER
#: Characters from one window of a long span to the next.
STRIDE = 16
#: Windows that are encoded at a time.
_WINDOWS = 4096
#: Characters of a secret that make a window one of a secret.
_SHOWN = 16
FILTERS, KERNEL, HIDDEN = 24, 5, 16
#: Labelled findings for training, calibration and threshold together.
FINDINGS = 9000
#: Share of the secrets set aside that the threshold must keep. It is above 0.99 so that fresh
#: findings reach that too.
RECALL = 0.995
SEED = 20

_PUNCTUATION = "+/_=-.:;,\"'()[]{}<>@#%&*!?$|\\~`^ \t\n\r"
_SYMBOLS = {c: 1 + n for n, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789" + _PUNCTUATION)}
_OTHER = len(_SYMBOLS) + 1
#: Channels: characters, other character, padding (0), upper case, inside.
CHANNELS = _OTHER + 3
_CODES = np.full(256, _OTHER, np.uint8)
for _c, _n in _SYMBOLS.items():
    _CODES[ord(_c)] = _n
    _CODES[ord(_c.upper())] = _n
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def encode(findings: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, upper-case flags and inside flags of (text, start, end) findings."""
    data = np.zeros((len(findings), WIDTH), np.uint8)
    real = np.zeros((len(findings), WIDTH), bool)
    inside = np.zeros((len(findings), WIDTH), bool)
    for row, (text, start, end) in enumerate(findings):
        parts = (
            (BEFORE, text[max(0, start - BEFORE) : start], True),
            (0, text[start : min(end, start + INSIDE)], False),
            (0, text[end : end + AFTER], False),
        )
        before = parts[0][1].encode("latin-1", "replace")
        middle = parts[1][1].encode("latin-1", "replace")
        after = parts[2][1].encode("latin-1", "replace")
        for at, part in ((BEFORE - len(before), before), (BEFORE, middle), (BEFORE + INSIDE, after)):
            data[row, at : at + len(part)] = np.frombuffer(part, np.uint8)
            real[row, at : at + len(part)] = True
        inside[row, BEFORE : BEFORE + len(middle)] = True
    return np.where(real, _CODES[data], 0), _UPPER[data] & real, inside


def windows(start: int, end: int) -> Iterable[tuple[int, int]]:
    """Windows of at most ``INSIDE`` characters that together cover the span."""
    last = max(start, end - INSIDE)
    for at in itertools.chain(range(start, last, STRIDE), (last,)):
        yield at, min(end, at + INSIDE)


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.weights = {
            "conv": rng.normal(0, 0.15, (KERNEL, CHANNELS, FILTERS)).astype(np.float32),
            "conv_bias": np.zeros(FILTERS, np.float32),
            "hidden": rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)).astype(np.float32),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": rng.normal(0, 0.3, HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    @staticmethod
    def _columns(encoded) -> np.ndarray:
        """Windows of one-hot characters with the two flags, (findings, positions, kernel, channels)."""
        codes, upper, inside = encoded
        hot = np.zeros((*codes.shape, CHANNELS), np.float32)
        np.put_along_axis(hot, codes[..., None].astype(np.int64), 1.0, axis=2)
        hot[..., _OTHER + 1], hot[..., _OTHER + 2] = upper, inside
        windows = np.lib.stride_tricks.sliding_window_view(hot, KERNEL, axis=1)
        return np.ascontiguousarray(windows.transpose(0, 1, 3, 2))

    def _forward(self, encoded):
        w, columns = self.weights, self._columns(encoded)
        n, positions = columns.shape[:2]
        flat = columns.reshape(n * positions, -1)
        conv = flat @ w["conv"].reshape(-1, FILTERS) + w["conv_bias"]
        conv = np.maximum(conv, 0).reshape(n, positions, FILTERS)
        best = conv.argmax(axis=1)
        pooled = np.concatenate([conv.max(axis=1), conv.mean(axis=1)], axis=1)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        return flat, conv, best, pooled, hidden, hidden @ w["out"] + w["out_bias"][0]

    def logits(self, encoded, batch: int = 512) -> np.ndarray:
        parts = [
            self._forward([x[a : a + batch] for x in encoded])[-1]
            for a in range(0, len(encoded[0]), batch)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def largest_logits(self, findings: list[tuple[str, int, int]]) -> np.ndarray:
        """The largest logit over the windows of each finding."""
        best = np.full(len(findings), -np.inf, np.float32)
        parts = (
            (row, (text, *window))
            for row, (text, start, end) in enumerate(findings)
            for window in windows(start, end)
        )
        while some := list(itertools.islice(parts, _WINDOWS)):
            rows, seen = zip(*some)
            np.maximum.at(best, list(rows), self.logits(encode(list(seen))))
        return best

    def probabilities(self, findings: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probabilities that the findings are secrets."""
        logits = self.largest_logits(findings).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))

    def _gradients(self, encoded, labels):
        w = self.weights
        flat, conv, best, pooled, hidden, logits = self._forward(encoded)
        n, positions, _ = conv.shape
        error = ((1 / (1 + np.exp(-logits)) - labels) / n).astype(np.float32)
        to_hidden = np.outer(error, w["out"]) * (hidden > 0)
        to_pooled = to_hidden @ w["hidden"].T
        to_conv = np.repeat(to_pooled[:, None, FILTERS:] / positions, positions, axis=1)
        rows, filters = np.indices(best.shape)
        to_conv[rows, best, filters] += to_pooled[:, :FILTERS]
        to_conv = (to_conv * (conv > 0)).reshape(n * positions, FILTERS)
        return {
            "conv": (flat.T @ to_conv).reshape(w["conv"].shape),
            "conv_bias": to_conv.sum(axis=0),
            "hidden": pooled.T @ to_hidden,
            "hidden_bias": to_hidden.sum(axis=0),
            "out": hidden.T @ error,
            "out_bias": np.array([error.sum()], np.float32),
        }

    def train(self, encoded, labels: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 2e-3):
        rng = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for a in range(0, len(order), batch):
                rows = order[a : a + batch]
                step += 1
                found = self._gradients([x[rows] for x in encoded], labels[rows])
                for k, g in found.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    size = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    self.weights[k] -= (rate / (1 - 0.9**step) * first[k] / size).astype(np.float32)

    def calibrate(self, logits: np.ndarray, labels: np.ndarray):
        """Platt scaling: scale and shift of the logits that fit the labels best."""
        x, y = logits.astype(np.float64), labels.astype(np.float64)
        positive, negative = y.sum(), len(y) - y.sum()
        y = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))

        def loss(scale, shift):
            z = scale * x + shift
            return float(np.sum(np.logaddexp(0, z) - y * z))

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(self.scale * x + self.shift, -40, 40)))
            slope = p * (1 - p) + 1e-9
            gradient = np.array([((p - y) * x).sum(), (p - y).sum()])
            curve = np.array([[(slope * x * x).sum(), (slope * x).sum()], [(slope * x).sum(), slope.sum()]])
            change = np.linalg.solve(curve + 1e-6 * np.eye(2), gradient)
            # A full step may overshoot where the logits part the labels almost without error.
            now = loss(self.scale, self.shift)
            while loss(self.scale - change[0], self.shift - change[1]) > now and np.abs(change).max() > 1e-9:
                change = change / 2
            self.scale, self.shift = self.scale - change[0], self.shift - change[1]
            if np.abs(change).max() < 1e-9:
                break


# Openings and alphabets of common credentials, and words of neutral contexts.
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_FORMATS = [
    ("ghp_", _BASE64, 36, 36), ("gho_", _BASE64, 36, 36), ("github_pat_", _BASE64 + "_", 40, 70),
    ("sk_live_", _BASE64, 24, 32), ("rk_live_", _BASE64, 24, 32), ("sk-", _BASE64, 40, 48),
    ("xoxb-", "0123456789", 24, 24), ("xoxp-", "0123456789abcdef-", 40, 60),
    ("AIza", _BASE64 + "_-", 35, 35), ("glpat-", _BASE64 + "_-", 20, 20), ("npm_", _BASE64, 36, 36),
    ("SG.", _BASE64 + "_-", 60, 66), ("ya29.", _BASE64 + "_-", 50, 90), ("", _BASE64 + "+/", 32, 64),
    ("", _BASE64, 16, 32), ("", _BASE64, 16, 20), ("", "0123456789abcdef", 32, 64), ("", "0123456789ABCDEF", 32, 64),
    ("AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16),
]
_KEY_CONTEXTS = [
    "password = ", "token: ", "secret=", "api_key: '", "Authorization: Bearer ", "export KEY=",
    "credentials: ", "the key is ", "private key ", "access_token=", "client_secret: \"", " ", "= \"", "(", "",
]
_PLAIN_CONTEXTS = [
    "see ", "in the file ", "commit ", "sha256:", "checksum ", "version ", "class ", "import ",
    "https://host.example/", "the word ", "id ", " ", "", "(", "etag: ", "href=\"", "and then ",
]
_SYLLABLES = (
    "re tion the and ing ed er on st en an th es in or ha he nd ou ea ver ung ich ein le qu eau ment "
    "con de la os as ción ado th sh wh ly st ck ght rst sch str nd ng ious ness data table index user value page test get set main config service"
).split()


def _word(rng: random.Random, low: int, high: int) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(low, high)))


def _sounds(rng: random.Random) -> str:
    """A long word of no language: groups of consonants and vowels."""
    group = lambda letters, most: "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))
    return "".join(group("bcdfghjklmnpqrstvwxyz", 3) + group("aeiouy", 2) for _ in range(rng.randint(5, 9)))


def _secret(rng: random.Random) -> str:
    if rng.random() < 0.08:
        part = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
        return f"eyJ{part(24)}.eyJ{part(40)}.{part(32)}"
    opening, alphabet, low, high = rng.choice(_FORMATS)
    return opening + "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))


def _look_alike(rng: random.Random) -> tuple[str, bool]:
    """A span that is no secret, and whether it needs a context that says so."""
    kind = rng.randrange(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == 0:
        return "_".join(_word(rng, 1, 3) for _ in range(rng.randint(3, 5))) + rng.choice(["", "2", "_1"]), False
    if kind == 1:
        return "/".join(_word(rng, 1, 3) for _ in range(rng.randint(3, 6))) + f"/{digits(rng.randint(1, 4))}", False
    if kind == 2:
        return "".join(_word(rng, 1, 2).capitalize() for _ in range(rng.randint(4, 7))) + rng.choice(["", "1", "V2"]), False
    if kind == 3:
        return f"20{digits(2)}-{digits(2)}-{digits(2)}-{_word(rng, 2, 4)}-{_word(rng, 1, 3)}", False
    if kind == 4:
        return "-".join(_word(rng, 1, 3) for _ in range(rng.randint(3, 6))) + f"-{digits(rng.randint(1, 3))}", False
    if kind == 5:
        return _word(rng, 7, 12) + rng.choice(["", "", digits(2)]), False
    if kind == 6:
        return (_word(rng, 7, 12) + rng.choice(["", digits(1)])).upper(), False
    if kind == 7:
        return rng.choice(["=", "-", "_", "0", "1", "a", "xX"]) * rng.randint(20, 40) + rng.choice(["", "1", "a0"]), False
    if kind == 8:
        return rng.choice(["", "www."]) + ".".join(_word(rng, 2, 4) for _ in range(rng.randint(2, 4))) + rng.choice([".org", ".html", ".tar.gz", ""]), False
    if kind == 9:
        return rng.choice(".-/_").join(digits(rng.randint(2, 4)) for _ in range(rng.randint(5, 7))), False
    if kind == 10:
        word = _word(rng, 6, 9)
        plain = [word, word.capitalize(), word.upper(), f"{word}.", f"{word}...{_word(rng, 1, 2)}"]
        return rng.choice([*plain, _sounds(rng), _sounds(rng)]), False
    return "".join(rng.choice("0123456789abcdef") for _ in range(40)), True


def _joined(rng: random.Random) -> str:
    """A long path, address or key that a token may be joined to."""
    size, out = rng.randint(20, 160), rng.choice(["//", "/", "", ""])
    joint = rng.choice(["/", "/", ".", "_"])
    while len(out) < size:
        piece = rng.randrange(6)
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 8)))
        if piece == 0:
            out += rng.choice(["v", "T", "B", "p", "20", ""]) + digits
        elif piece == 1:
            out += _word(rng, 1, 2) + rng.choice("._-") + _word(rng, 1, 2)
        elif piece == 2:
            out += "".join(_word(rng, 1, 2).capitalize() for _ in range(rng.randint(1, 3)))
        else:
            out += rng.choice([str.lower, str.lower, str.upper])(_word(rng, 1, 4))
        out += joint
    return out


def _late_secret(rng: random.Random) -> tuple[str, int, int]:
    """A long run, and where in it the secret stands."""
    front = _joined(rng) + rng.choice(["", "", "key=", "value=", "id="])
    secret = _secret(rng)
    if rng.random() < 0.5:
        secret = "".join(rng.choice(_BASE64) for _ in range(rng.randint(20, 40)))
    behind = "/" + _joined(rng)[: rng.randint(4, 60)].rstrip("./_-") if rng.random() < 0.2 else ""
    return front + secret + behind, len(front), len(front) + len(secret)


def _placed_findings(count: int, seed: int):
    """Findings, labels, and where the secret stands in the text (nowhere: 0, 0)."""
    rng = random.Random(seed)
    findings, labels, places = [], [], []
    for n in range(count):
        label, place = n % 2, None
        if label and rng.random() < 0.25:
            span, *place = _late_secret(rng)
            context = rng.choice(_KEY_CONTEXTS + _PLAIN_CONTEXTS)
        elif label:
            span, context = _secret(rng), rng.choice(_KEY_CONTEXTS)
            place = [0, len(span)]
        elif rng.random() < 0.25:
            span, context = _joined(rng).rstrip("./_-"), rng.choice(_KEY_CONTEXTS + _PLAIN_CONTEXTS)
        else:
            span, needs = _look_alike(rng)
            context = rng.choice(["commit ", "sha256:", "checksum ", "etag: "] if needs else _PLAIN_CONTEXTS)
        left = " ".join(_word(rng, 1, 3) for _ in range(rng.randint(0, 5)))
        right = rng.choice(["", " ", "\"", "'", ".", ", ", "\n", ")", ";"]) + _word(rng, 1, 3)
        text = f"{left} {context}{span}{right}"
        start = len(left) + 1 + len(context)
        findings.append((text, start, start + len(span)))
        labels.append(label)
        places.append((start + place[0], start + place[1]) if place else (0, 0))
    return findings, np.array(labels, np.float32), places


def labelled_findings(count: int = FINDINGS, seed: int = SEED):
    """Findings (text, start, end) and labels, 1 for secrets, half of each."""
    return _placed_findings(count, seed)[:2]


def _labelled_windows(findings, places):
    """The windows of the findings, and 1 for those that show a secret.

    Windows that show only a little of a secret are left out.
    """
    out, labels = [], []
    for (text, start, end), (begin, stop) in zip(findings, places):
        for a, b in windows(start, end):
            shown = min(b, stop) - max(a, begin)
            if shown <= 0 or shown >= min(_SHOWN, stop - begin):
                out.append((text, a, b))
                labels.append(shown > 0)
    return out, np.array(labels, np.float32)


def found_scores(network: Network, findings, places) -> np.ndarray:
    """The best probability of a candidate in each finding's text that covers its secret; 0 if none does."""
    owners, spans = [], []
    for n, ((text, _, _), (begin, stop)) in enumerate(zip(findings, places)):
        for start, _, _, end in candidates(text):
            # Marks at the ends of a run are no part of the candidate.
            if start <= begin + 1 and end >= stop - 1:
                owners.append(n)
                spans.append((text, start, end))
    scores = np.zeros(len(findings))
    if spans:
        np.maximum.at(scores, owners, network.probabilities(spans))
    return scores


@functools.lru_cache(1)
def trained() -> Network:
    """The network trained on two thirds, calibrated and cut on the rest of the findings."""
    findings, labels, places = _placed_findings(FINDINGS, SEED)
    fold = np.random.default_rng(SEED).permutation(len(labels))
    learn, tune, cut = np.split(fold, [len(fold) * 4 // 6, len(fold) * 5 // 6])
    seen, shown = _labelled_windows([findings[i] for i in learn], [places[i] for i in learn])
    network = Network()
    network.train(encode(seen), shown)
    network.calibrate(network.largest_logits([findings[i] for i in tune]), labels[tune])
    secrets = [i for i in cut if labels[i]]
    # A secret that no candidate covers cannot be won back by a lower threshold.
    scores = found_scores(network, [findings[i] for i in secrets], [places[i] for i in secrets])
    kept = np.sort(scores[scores > 0])
    network.threshold = float(min(kept[int(len(kept) * (1 - RECALL))], 0.5))
    return network
