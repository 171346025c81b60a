"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines(docs, least=10):
    """doc_id -> (n_lines, n_dropped, kept)."""
    key = lambda x: x.strip(WS).translate(LOWER)
    seen = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    out = {}
    for i, t in docs:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if not (key(x) and seen[key(x)] >= least)]
        out[i] = (len(all_), len(all_) - len(kept), "\n".join(kept))
    return out


def shingle_set(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def components(docs, width=5, percent=75):
    """doc_id -> (n_shingles, component_id)."""
    sets = {i: shingle_set(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        both = Counter()
        for k in s:
            both.update(index[k])
            index[k].append(i)
        for j, c in both.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def exact(docs):
    """doc_id -> (keep_id, group_size, kept, digest)."""
    groups = defaultdict(list)
    norm = {i: "".join(c for c in (t or "") if c not in WS) for i, t in docs}
    for i, t in docs:
        groups[norm[i]].append((-len(t or ""), i))
    return {i: (min(groups[norm[i]])[1], len(groups[norm[i]]), min(groups[norm[i]])[1] == i, hashlib.sha256(norm[i].encode()).hexdigest()) for i, _ in docs}


SECRETS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, rule, ok) in enumerate(SECRETS) for m in rule.finditer(text or "") if ok(m)]
    return sorted(found)


def redacted(text, mask="[SECRET]"):
    out, at = "", 0
    for start, _, _, end in spans(text):
        if start >= at:
            out += text[at:start] + mask
        at = max(at, end)
    return out + text[at:]


def repeats(words):
    """For each place, the longest run that begins there and occurs elsewhere too."""
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i], out[j] = max(out[i], k), max(out[j], k)
    return out


def quality(text, span_words=8, max_covered=0.30, max_longest=50, longest_share=0.15):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest, base_failed, kept)."""
    text = text or ""
    w = WORD.findall(text)
    n, runs = len(w), repeats(w)
    windows = Counter(tuple(w[k : k + 3]) for k in range(n - 2))
    three = {k + j for k in range(n - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    long = {k + j for k in range(n) if runs[k] >= span_words for j in range(runs[k])}
    full = [x for x in text.split("\n") if x.strip(WS)]
    failed = n < 50 or 100 * len(three) > 50 * n
    top = max(runs, default=0)
    kept = not failed and len(long) <= max_covered * n and (top <= max_longest or top <= longest_share * n)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(three), len(long), top, failed, kept


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def filled(doc_id, text, seed=1):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", i, j - i, f"<P>{prefix}<S>{suffix}<M>{middle}"


def planted_words(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def runs(w, least=6, exponent=4):
    """(start, end, period) of every run, period by period."""
    n, out = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def run_digest(doc_id, text):
    """The columns of the query of periodic runs."""
    w = planted_words(doc_id, text)
    found = runs(w)
    best = (None,) * 4
    if found:
        s, e, q = max(found, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(found), *best, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in gone))
