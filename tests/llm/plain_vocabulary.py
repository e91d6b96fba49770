"""Plain versions of the operators on words, phrases and runs."""

import hashlib
import re
from collections import defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def one_letter_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, dominance=5):
    """(word, form, root, n, n_near, form_n) from a word's occurrences; every pair of words is compared."""
    near, form = defaultdict(set), {}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_letter_apart(a, b):
                near[a].add(b)
                near[b].add(a)
    for word in words:
        if near[word]:
            best = min(near[word], key=lambda w: (-counts[w], w))
            if counts[best] >= dominance * counts[word]:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted((w, form.get(w), root(w), counts[w], len(near[w]), counts.get(form.get(w))) for w in words)


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain_matches(texts, items, window=10, slop=2):
    """Per text: words, words hit, items hit, items nearly hit; every start of every text is tried."""
    windows = defaultdict(set)
    for ident, text in items:
        words = terms(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[k : k + size])].add(ident)
    out = []
    for text in texts:
        words = terms(text)
        places = defaultdict(set)
        for p, word in enumerate(words):
            places[word].add(p)
        hit, exact, near = set(), set(), set()
        for phrase, idents in windows.items():
            size = len(phrase)
            for s in range(-slop, len(words) + slop):
                if tuple(words[max(s, 0) : max(s, 0) + size]) == phrase and s >= 0:
                    hit |= set(range(s, s + size))
                    exact |= idents
                if all(any(s + k + e in places[w] for e in range(-slop, slop + 1)) for k, w in enumerate(phrase)):
                    near |= idents
        out.append((len(words), hit, exact - {None}, near - {None}))
    return out


def plain_runs(words):
    """(start, length, period) of every run; each lag is compared in full, smallest periods by trial."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            a, b = i, j + q
            smaller = any(all(words[x] == words[x + d] for x in range(a, b - d)) for d in range(1, q))
            if j > i and b - a >= max(6, 4 * q) and not smaller:
                out.append((a, b - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


