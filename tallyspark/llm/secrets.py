"""Secret scan (operator 8): patterns, and sliding-window entropy of candidate strings.

Base spans come from three patterns, leftmost and without overlap for each kind
(matches that are too short are dropped). The method adds spans: in each
candidate string (a long run of key-like characters) and for each character
class, a window slides over the runs of the class while character counts and the
window's Shannon entropy are updated by the one character that enters and the
one that leaves. Windows at or over the class's limit that mix letters and
digits join to spans. Limits are fitted to the alphabets: hexadecimal, small
letters and digits, capitals and digits, all three of these, and base64. Runs of
12 to 19 letters and digits have a window of 12 and must change between letters
and digits three times, or twice with letters of both cases.

The allow list takes stretches out of a candidate, and windows slide over what is
left: UUIDs, integrity digests, and parts between separators that hold a
placeholder word or an alphabet (of parts over 64 characters the word alone).

Defined cases: null and empty texts have no spans; offsets are code points, end
exclusive; texts of any length are scanned whole in linear time; repeated rows
each get their own result.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame

from tallyspark.llm.common import map_docs

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_lower", "entropy_upper", "entropy_mixed", "entropy_short")

CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{12,}")
WINDOW = 20
#: Character class and least bits per character of a window; random strings of
#: 20 have about 3.4 (16 characters), 3.8 (32), 3.9 (36), 4.0 (62) and 4.1 (64).
CLASSES = {"entropy_hex": (re.compile(r"[0-9A-Fa-f]{20,}"), 3.0), "entropy_base64": (re.compile(r"[A-Za-z0-9+/=_-]{20,}"), 3.9),
           "entropy_lower": (re.compile(r"[a-z0-9]{20,}"), 3.4), "entropy_upper": (re.compile(r"[A-Z0-9]{20,}"), 3.3),
           "entropy_mixed": (re.compile(r"[A-Za-z0-9]{20,}"), 3.6)}
BOTH_CASES = ("entropy_mixed",)   # small letters and capitals in each window
SHORT = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{12,19}(?![A-Za-z0-9])")
SHORT_WINDOW, SHORT_LEAST = 12, 3.0
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
_CHANGE = re.compile(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]")
#: What isn't a secret: UUIDs and integrity digests, and parts between separators with a placeholder or an alphabet.
ALLOW = [re.compile(p) for p in (r"(?i)(?<![0-9a-z])[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-z])", r"(?<![A-Za-z0-9])sha(256|384|512)-[A-Za-z0-9+/]+={0,2}")]
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|xxxx|abcdefghij|0123456789")
PART = re.compile(r"[A-Za-z0-9]+")
LONGEST_PLACEHOLDER = 64
_NLOGN = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def entropy_spans(text: str, pattern: re.Pattern, least: float, window: int = WINDOW,
                  both_cases: bool = False) -> list[tuple[int, int]]:
    """Joined windows of the class's runs with at least ``least`` bits per character."""
    nlogn = _NLOGN if window <= WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    out: list[tuple[int, int]] = []
    most = window * (math.log2(window) - least) + 1e-9   # of the sum of n log n
    for m in pattern.finditer(text):
        run, counts, total, digits, letters, capitals = m.group(), {}, 0.0, 0, 0, 0
        for i, c in enumerate(run):
            n = counts.get(c, 0)
            counts[c] = n + 1
            total += nlogn[n + 1] - nlogn[n]
            digits += c.isdigit()
            letters += c.isalpha()
            capitals += c.isupper()
            if i >= window:
                o = run[i - window]
                n = counts[o]
                counts[o] = n - 1
                total += nlogn[n - 1] - nlogn[n]
                digits -= o.isdigit()
                letters -= o.isalpha()
                capitals -= o.isupper()
            if i >= window - 1 and total <= most and digits and letters and (not both_cases or 0 < capitals < letters):
                a, b = m.start() + i - window + 1, m.start() + i + 1
                if out and a <= out[-1][1]:
                    out[-1] = out[-1][0], b
                else:
                    out.append((a, b))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the three patterns."""
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return sorted(out)


def free_stretches(run: str) -> list[tuple[int, int]]:
    """What the allow list leaves of a candidate."""
    gone = [m.span() for a in ALLOW for m in a.finditer(run)]
    if PLACEHOLDER.search(run):
        for part in PART.finditer(run):
            words = [(part.start() + m.start(), part.start() + m.end()) for m in PLACEHOLDER.finditer(part.group())]
            gone += [part.span()] if words and part.end() - part.start() <= LONGEST_PLACEHOLDER else words
    out, at = [], 0
    for a, b in sorted(gone):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, len(run))]


def short_spans(text: str) -> list[tuple[int, int]]:
    """Joined windows of the runs of 12 to 19 letters and digits that change between the two like keys."""
    out = []
    for m in SHORT.finditer(text):
        run, changes = m.group(), len(_CHANGE.findall(m.group()))
        if changes > 2 or changes == 2 and run.upper() != run != run.lower():
            out += [(m.start() + a, m.start() + b) for a, b in entropy_spans(run, PART, SHORT_LEAST, SHORT_WINDOW)]
    return out


def all_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = list(base)
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not _DIGIT.search(run) or not _LETTER.search(run):
            continue
        for at, to in free_stretches(run):
            part, start = run[at:to], m.start() + at
            if len(part) >= WINDOW:
                for kind, (pattern, least) in CLASSES.items():
                    out += [(start + a, KINDS.index(kind), start + b) for a, b in entropy_spans(part, pattern, least, both_cases=kind in BOTH_CASES)]
            out += [(start + a, KINDS.index("entropy_short"), start + b) for a, b in short_spans(part)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def run(ids: list, texts: list) -> dict:
        out: dict = {"doc_id": ids, "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
        for t in texts:
            base = base_spans(t)
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(sum(s[1] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(all_spans(t, base)))
        return out

    return map_docs(docs, "doc_id bigint,n_assign bigint,n_access bigint,n_hex bigint,base_sha256 string,spans string", run)
