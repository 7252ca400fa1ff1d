"""Small documents with every awkward case, and brute-force versions of the contracts."""

import hashlib
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept boolean, length int, uid string"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = " ".join(f"word{i % 97}x{i % 13}" for i in range(160))
PASSAGE = " ".join(f"passage{i}" for i in range(70))


def texts():
    near = BASE.replace("word5x5", "other", 1)
    return [
        None, "", " \n\t ", "one", "One", "two words", "a b c d e", "A  b\nc d E", BASE, BASE, near, BASE.upper(),
        BASE[:700] + " tail " + "q r s t " * 30, "first " + PASSAGE + " end", "other start " + PASSAGE, "x" * 5000, "ab" * 900,
        "é ü ß " * 400, "line of words here\n" * 60, "long " + " ".join(f"w{i}" for i in range(12000)), "café \U0001f600 'tis <b> 100%",
    ]


def frame(spark, rows=None):
    """The cases with null and repeated ids, repeated rows, and columns named like ours."""
    rows = texts() if rows is None else rows
    data = [(i, t, "en" if i % 2 else None, "s", len(t or ""), "r", True, 1, "u") for i, t in enumerate(rows)]
    if data:
        data += [data[-1], (None, rows[-1], "en", None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


def near_duplicates(rows):
    """(n_shingles, component_id) per (doc_id, text) row of the cases."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    named = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(rows[i][0], len(sets[i]), named[find(i)]) for i in range(len(rows))]


def repeats(rows, length=400):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data):
        cut = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                cut[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(d, cut) if not c)
        out.append((doc_id, len(d), sum(cut), len(re.findall(b"\1+", bytes(cut))), hashlib.sha256(kept).hexdigest()))
    return out


def contaminated(rows, items, window=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))

    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i : i + window])].add(str(item))
    out = []
    for doc_id, t in rows:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def plain(df, *columns):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=key)


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
