"""The contracts of the corpus operators, written plainly for small tables."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def personal(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if _valid(kind, m.group())]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def personal_row(text):
    spans = personal(text)
    n = Counter(kind for kind, _, _ in spans)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (*(n[k] for k in PATTERNS), hashlib.sha256(listed.encode()).hexdigest())


def benchmark_windows(items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add(item)
    return windows


def passages(text, windows):
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, items = [0] * len(words), set()
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if found := windows.get(tuple(words[k : k + n])):
                items |= found
                hit[k : k + n] = [1] * n
    return len(words), sum(hit), items


def shingle_set(text, width):
    words = SPACED.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(width)), strict=False))


def components(texts, width, percent=80):
    """By position: the least position that links reach."""
    sets, parent = [shingle_set(t, width) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def measures(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times, covered, lines, copied = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if SPACED.search(line):
            copied += line in lines
            lines.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copied, len(covered), failed


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def tokens(text):
    return [*SPACED.findall((text or "").translate(LOWER)), "\n"]


def word_scores(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of each (doc_id, text)."""
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        own = tokens(text)
        total = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        yield held_out(i), len(own), sum(counts[t] > 0 for t in own), n, total


def context_tree(rows, depth):
    """A function from text to log10 probability, by the recursion as it is written."""
    counts = defaultdict(lambda: [0, 0])

    def decisions(text):
        stream = (" ".join(tokens(text)[:-1]) + "\n").encode()
        padded = b"\n" * depth + stream
        for i, byte in enumerate(stream):
            for b in range(8):
                yield padded[i : i + depth], 1 << b | byte >> 8 - b, byte >> 7 - b & 1

    for i, text in rows:
        if not held_out(i):
            for context, node, bit in decisions(text):
                for d in range(depth + 1):
                    counts[context[depth - d :], node][bit] += 1
    share, deeper = {}, defaultdict(float)
    for context, node in sorted(counts, key=lambda k: -len(k[0])):
        zeros, ones = counts[context, node]
        own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)
        weighted, share[context, node] = own, 1.0
        if len(context) < depth:
            other = deeper[context, node]
            top = max(own, other)
            weighted = top + math.log(math.exp(own - top) + math.exp(other - top)) - math.log(2)
            share[context, node] = math.exp(own - math.log(2) - weighted)
        if context:
            deeper[context[1:], node] += weighted

    def score(text):
        total = 0.0
        for context, node, bit in decisions(text):
            chance = 0.5
            for d in range(depth, -1, -1):
                key = context[depth - d :], node
                seen = counts[key] if key in counts else (0, 0)
                weight = share.get(key, 1.0 if d == depth else 0.5)
                chance = weight * (seen[bit] + 0.5) / (sum(seen) + 1) + (1 - weight) * chance
            total += math.log10(chance)
        return total

    return score


def _chunk_list(text, m):
    """Chunks of one text as (start, end, words) in bytes, by looking at every window of words."""
    raw = text.encode()
    spans = [(w.start(), w.end()) for w in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    words = m.Words(pa.array([text]), m.SPACED, lower=False)
    value = [int(v) for v in m.units(words)]
    gear = [sum(value[j - a] << (m.SHIFT * a) for a in range(m.COVERED)) % 2**64 for j in range(m.COVERED - 1, len(value))]
    found = set()
    for s in range(len(gear) - m.WINDOW + 1):
        least = min(gear[s : s + m.WINDOW])
        found.add(max(j for j in range(s, s + m.WINDOW) if gear[j] == least))
    found, stretches = sorted(found), []
    for j in found:
        tied = stretches and gear[stretches[-1][-1]] == gear[j] and j - stretches[-1][-1] <= m.COVERED
        stretches[-1].append(j) if tied else stretches.append([j])
    kept, edge = [], m.RUN_WORDS
    for own in stretches:
        kept += [j for i, j in enumerate(own) if i <= edge or len(own) - 1 - i <= edge or (i - edge) % m.PERIODS == 0]
    ends = [0, *(spans[j + m.COVERED - 1][0] for j in kept), len(raw)]
    return [(a, b, sum(a <= s < b for s, _ in spans)) for a, b in zip(ends, ends[1:]) if b > a]


def repeated_passages(rows, m):
    """(doc_id, start, end, words, chunks, first_doc_id, first_start, least_doc_id) of distinct rows, in lists and dicts."""
    rows = [(i, t) for i, t in dict.fromkeys(rows) if t is not None]
    cut = {(i is None, i or 0, t if i is None else ""): (i, t.encode(), _chunk_list(t, m)) for i, t in rows}
    first = {}
    for key in sorted(cut):
        for a, b, _ in cut[key][2]:
            first.setdefault(cut[key][1][a:b], (key, a))
    for key, (doc, raw, own) in cut.items():
        run = []
        for a, b, n in [*own, (None, None, 0)]:
            if a is not None and first[raw[a:b]] != (key, a):
                run.append((a, b, n))
                continue
            if sum(n for *_, n in run) >= m.RUN_WORDS:
                whence = [first[raw[x:y]] for x, y, _ in run]
                ids = [cut[k][0] for k, _ in whence if cut[k][0] is not None]
                yield (doc, run[0][0], run[-1][1], sum(n for *_, n in run), len(run), cut[whence[0][0]][0], whence[0][1], min(ids, default=None))
            run = []
