"""Plain single-process versions of the operators, written from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_dup(rows):
    """rows: (doc_id, text) -> {index: (n_shingles, component)}; doc_id not null."""
    sets = []
    for _, text in rows:
        w = WORD.findall(low(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 62)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], doc_id)
    return [(doc_id, len(sets[i]), least[find(i)], doc_id == least[find(i)]) for i, (doc_id, _) in enumerate(rows)]


def line_dedup(rows):
    key = lambda line: low(line.strip(SPACES))
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and doc_id is not None:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < 3 or doc_id == max(holders[key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(rows, size=35):
    texts = [WORD.findall(text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        lost = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                lost.update(range(i, i + size))
        out.append((doc_id, len(w), len(lost), " ".join(x for i, x in enumerate(w) if i not in lost)))
    return out


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    repeat = len({i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * repeat > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed)


def quality(rows, limit=0.5):
    """rows: (doc_id, text, host)."""
    found = [measures(t) for _, t, _ in rows]
    hosts = defaultdict(lambda: [0, 0])
    for (_, _, host), m in zip(rows, found):
        if host is not None:
            hosts[host][0] += 1
            hosts[host][1] += m[-1]
    rates = [f / n for n, f in hosts.values()]
    bad = set()
    if rates:
        mean = sum(rates) / len(rates)
        spread = sum((r - mean) ** 2 for r in rates) / len(rates)
        strength = min(1e6, max(mean * (1 - mean) / spread - 1, 1)) if spread > 0 else 1e6
        bad = {h for h, (n, f) in hosts.items() if (f + mean * strength) / (n + strength) > limit}
    return [(doc_id, *m, not m[-1] and host not in bad) for (doc_id, _, host), m in zip(rows, found)]


def contamination(rows, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall(low(text))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc_id, text in rows:
        w = BENCH_WORD.findall(low(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found - {None}), sha(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def secrets(text):
    text = text or ""
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def judged_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = low(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]
