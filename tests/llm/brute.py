"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def substring_dedup(rows, width=13):
    """rows: (id, text). {index: (n_words, n_removed, kept text)}."""
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[k:k + width])
            least[key] = min(least.get(key, i), i)
    out = {}
    for n, (i, t) in enumerate(rows):
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1) if i is not None else ():
            if least[tuple(w[k:k + width])] < i:
                gone |= set(range(k, k + width))
        out[n] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, width=3):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def near_components(rows, percent=85, width=3):
    """rows: (id, text) with distinct ids. {id: (n_shingles, component)}; exact, by a full inverted index."""
    sets = {i: shingles(t, width) for i, t in rows}
    index, parent = {}, {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in sorted(sets):
        seen = {}
        for s in sets[i]:
            for j in index.setdefault(s, []):
                seen[j] = seen.get(j, 0) + 1
            index[s].append(i)
        for j, both in seen.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def source_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """{source: size} to {source: target} by resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(w[s] for s in free)
        full = {s for s in free if left * w[s] / total >= cap * sizes[s]}
        if not full:
            return out | {s: left * w[s] / total for s in free}
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    from collections import Counter
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def url_rule(url, rules):
    """(host, path, rule, verdict)."""
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", "", None, None
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


def template(text, units):
    """[(template, value)] of a text's tokens, where names, numbers and units are placeholders."""
    out = []
    pattern = re.compile(r"(?:[A-Za-z0-9\u0080-\U0010ffff]|(?<=[0-9])[.,](?=[0-9]))+")
    last = 0
    for m in pattern.finditer(text or ""):
        word = m[0]
        low = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in word)
        capitals = sum("A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" for c in word)
        opens = not out or re.search(r"[.!?:;\n]", text[last:m.start()])
        if re.search(r"[0-9]", word):
            t = "#NUMBER"
        elif out and out[-1][0] == "#NUMBER" and low in units:
            t = "#UNIT"
        elif not opens and low[0] != word[0] and capitals == 1 and len(word.encode()) > 1:
            t = "#NAME"
        else:
            t = low
        out.append((t, low))
        last = m.end()
    return out


def leaks(docs, items, units, width=8, min_literals=4, min_tokens=5, min_share=0.4):
    """docs, items: (id, text) with distinct ids. {(doc, item): (matched, windows, reparameterised)}."""
    from collections import defaultdict
    out = {}
    tokens = [(i, template(t, units)) for i, t in docs]
    for item, text in items:
        it = template(text, units)
        if len(it) < min_tokens:
            continue
        w = min(width, len(it))
        total = len(it) - w + 1
        windows = defaultdict(list)
        for k in range(total):
            key = tuple(t for t, _ in it[k:k + w])
            if sum(not t.startswith("#") for t in key) >= min(min_literals, w):
                windows[key].append(k)
        for doc, dt in tokens:
            shifts = defaultdict(list)
            for k in range(len(dt) - w + 1):
                for first in (dt[k][0], dt[k][1]) if dt[k][0] == "#NAME" else (dt[k][0],):
                    for p in windows.get((first, *(t for t, _ in dt[k + 1:k + w])), ()):
                        shifts[k - p].append(p)
            # What each alignment says of the item's slot values; those that contradict themselves don't count.
            maps = {}
            for shift, ps in shifts.items():
                pairs = {(it[p + j][1], dt[p + shift + j][1]) for p in ps for j in range(w) if it[p + j][0].startswith("#")}
                if len({a for a, _ in pairs}) == len(pairs):
                    maps[shift] = dict(pairs)
            # The largest alignment that has a value is right about it.
            said = {}
            for shift in sorted(maps, key=lambda s: (-len(set(shifts[s])), s)):
                for a, b in maps[shift].items():
                    said.setdefault(a, b)
            right = [s for s in maps if all(said[a] == b for a, b in maps[s].items())]
            places = {p for s in right for p in shifts[s]}
            changed = [any(a != b for a, b in maps[s].items()) for s in right]
            if places and len(places) / total >= min_share:
                out[doc, item] = (len(places), total, min(changed))
    return out


def resampling(docs, target, buckets=10000, share=(5, 100), min_words=20, seed=42):
    """docs: (id, text), target: texts. [(id, n_features, weight, score, rank)] in the order of docs."""
    import math
    import zlib
    from collections import Counter
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def grams(text):
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        out = [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets for n in (1, 2, 3) for k in range(len(w) - n + 1)]
        return len(w), out

    found = [grams(t) for _, t in docs]
    s, t = Counter(b for _, g in found for b in g), Counter(b for x in target for b in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (_, g) in zip(docs, found):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((k for k, (n, _) in enumerate(found) if n >= min_words),
                   key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0))
    for place, k in enumerate(order[:share[0] * len(order) // share[1]], 1):
        rows[k][4] = place
    return [tuple(r) for r in rows]


def toxicity(docs, labels, neighbours=15, any_weight=0.02, chance=10.0, nearest=0.05, prior=0.5):
    """docs: (id, text) with distinct ids, labels: {id: 0 or 1}, all of them examples. {id: (score, [(example id, similarity)])}."""
    import math
    import zlib
    from collections import Counter
    word = re.compile("[A-Za-z\u0080-\U0010ffff]+")
    bags = {i: Counter("".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in word.findall(t or "")) for i, t in docs}
    known = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5}
    train = sorted(i for i, t in docs if i in known and t is not None)
    total, n1 = len(train), sum(known[i] for i in train)
    seen = Counter(w for i in train for w in bags[i])
    toxic = Counter(w for i in train if known[i] for w in bags[i])
    df = Counter(w for b in bags.values() for w in b)
    weight = {}
    for w, n in seen.items():
        e = n * n1 / total
        chi2 = (toxic[w] - e) ** 2 * total / (e * (total - n) * (total - n1) / total + 1e-12)
        weight[w] = (math.log((1 + len(docs)) / (1 + df[w])) + 1) * (any_weight + math.sqrt(max(chi2 - chance, 0) / total))

    def unit(bag):
        v = {w: (1 + math.log(c)) * weight[w] for w, c in bag.items() if w in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {i: unit(bags[i]) for i in train}
    of_class = {y: sum(v == y for v in known.values()) / max(1, sum(known[i] == y for i in train)) for y in (0, 1)}
    importance = {i: of_class[known[i]] for i in train}
    told = [i for i in train if vectors[i]]
    rate = sum(known[i] * importance[i] for i in train) / sum(importance[i] for i in train)
    mute = [i for i in train if not vectors[i]]
    unknown = (sum(known[i] * importance[i] for i in mute) + rate) / (sum(importance[i] for i in mute) + 1)

    def vote(v, without=None):
        sims = {j: sum(x * vectors[j].get(w, 0) for w, x in v.items()) for j in told if j != without}
        near = sorted((j for j in sims if sims[j] > 0), key=lambda j: (-sims[j], j))[:neighbours]
        w = {j: importance[j] / (1 - min(sims[j], 1) + nearest) for j in near}
        scale = prior * sum(importance[j] for j in told) / len(told)
        return (sum(w[j] * known[j] for j in near) + scale * rate) / (sum(w.values()) + scale), [(j, sims[j]) for j in near]

    def logit(p):
        p = min(max(p, 1e-4), 1 - 1e-4)
        return math.log(p / (1 - p))

    x = [logit(vote(vectors[i], i)[0]) for i in told]
    iw, y = [importance[i] for i in told], [known[i] for i in told]
    a, b, whole = 1.0, 0.0, sum(iw)
    for _ in range(50):  # Newton steps of the weighted logistic loss, drawn to the identity
        p = [1 / (1 + math.exp(-(a * v + b))) for v in x]
        ga = sum(w * (q - t) * v for w, q, t, v in zip(iw, p, y, x)) + 1e-3 * (a - 1) * whole
        gb = sum(w * (q - t) for w, q, t in zip(iw, p, y)) + 1e-3 * b * whole
        s = [w * q * (1 - q) for w, q in zip(iw, p)]
        haa, hab = sum(k * v * v for k, v in zip(s, x)) + 1e-3 * whole, sum(k * v for k, v in zip(s, x))
        hbb = sum(s) + 1e-3 * whole
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    a = max(a, 0.0)
    out = {}
    for i, _ in docs:
        v = unit(bags[i]) if any(w in weight for w in bags[i]) else {}
        p, near = vote(v) if v else (None, [])
        out[i] = (1 / (1 + math.exp(-(a * logit(p) + b))) if v else unknown, near)
    return out
