"""Plain Python versions of the base results, from the contract's words."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    grams = collections.defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i:i + 5])].append(i)
    again = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, r = len(words), len(again)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, r, n < 10 or 100 * r > 20 * n)


def _spans(kinds, text):
    out = []
    for rank, (kind, pattern, ok) in enumerate(kinds):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return sorted(out)


SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m[0])) <= 15),
]


def digest(kinds, text):
    """Counts by kind, and the digest of the base spans."""
    spans = _spans(kinds, text)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    counts = collections.Counter(k for _, _, k, _ in spans)
    return (*[counts[k[0]] for k in kinds], hashlib.sha256(joined.encode()).hexdigest()), [f"{k}:{s}:{e}" for s, _, k, e in spans]
