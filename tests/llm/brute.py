"""The text operators again, in plain Python, for small fixtures."""

import hashlib
import re
from collections import Counter

import xxhash
from pyspark.sql import types as T

CLASHES = ["key", "h", "version", "segment", "kept", "deduped", "guess", "fp", "spans", "text_", "line_doc", "drop_keys"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in CLASHES],
])

LONG = "\n".join(f"Line {n % 700} of a very long text, with {n % 11} and password=abc{n % 5}def. " * 3 for n in range(2000))
#: Nulls, empty and very long texts, ties and repeated rows.
EDGES = [
    (1, None, "en"), (2, "", None), (3, " \t\n \n", "en"), (4, LONG, "en"), (4, LONG, "en"), (5, LONG + " end", "de"),
    (6, "one", "en"), (7, "one", None), (8, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (9, "One two  THREE four five six seven eight nine ten eleven twelve", "fr"), (9, "another text under one id", "fr"),
    (None, "no id here, but text enough to count as a line of it", "en"), (None, None, None),
    (None, "no id here, but text enough to count as a line of it", "en"), (10, "ÀÉ ß 日本語 text\x01\x00 \U0001f600", "de"),
    (11, "no id here, but text enough to count as a line of it", "de"), (-3, "12345 --- 678", "fr"),
    (12, "  NO ID HERE, but text enough to count as a line of it\t\nsecond line", None), (13, "\n\n\n", "en"),
]


def documents(spark, rows=EDGES):
    """A documents table with further columns whose names operators use inside."""
    return spark.createDataFrame(
        [(i, text, lang, "src0", None if text is None else len(text), *CLASHES) for i, text, lang in rows], SCHEMA
    )


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def deduped(rows, min_chars=20, min_docs=3):
    """[(id, text)] -> [(id, n_lines, n_dropped, kept)]."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders.setdefault(line_key(line), set()).add(i)
    keeper = {
        key: max(ids - {None}) for key, ids in holders.items() if len(ids - {None}) >= min_docs
    }
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if line_key(x) not in keeper or keeper[line_key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, shingle=4):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    runs = [b" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The smallest node of each one's component."""
    nodes = sorted(nodes)
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if linked(a, b):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near(rows, max_bits=4):
    """[(id, text)] -> [(id, fingerprint, component_id)]."""
    prints = [fingerprint(text) for _, text in rows]
    group = groups(set(prints), lambda a, b: (a ^ b).bit_count() <= max_bits)
    first = {}
    for (i, _), fp in zip(rows, prints):
        if i is not None:
            first[group[fp]] = min(i, first.get(group[fp], i))
    return [(i, fp, first.get(group[fp])) for (i, _), fp in zip(rows, prints)]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(rows, items, size=10):
    """[(id, text)] -> [(id, n_words, n_hit, item ids as sorted text)]."""
    windows = {}
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[k:k + size]), set()).add(item)
    out = []
    for i, text in rows:
        own, hit, found = words(text), set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(own) - length + 1):
                window = tuple(own[k:k + length])
                if window in windows:
                    hit.update(range(k, k + length))
                    found |= windows[window]
        out.append((i, len(own), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def top_grams(text, profile=300):
    """A document's n-grams by rank: as numbers of 21 bits a letter, for ties."""
    clean = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    if not any(map(str.isalpha, clean)):
        return []
    counts = Counter()
    for word in clean.split(" "):
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[k:k + 2] for k in range(len(padded) - 1))
        counts.update(padded[k:k + 3] for k in range(len(padded) - 2))
    number = lambda gram: sum(ord(c) << 21 * k for k, c in enumerate(reversed(gram)))
    return [gram for gram, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))[:profile]]
