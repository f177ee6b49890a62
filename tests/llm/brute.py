"""Plain versions of the pair operators."""

from collections import Counter


def words(text):
    return (text or "").encode().lower().split()


def shingles(ws, width=5):
    return [tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)] if len(ws) >= width else [tuple(ws)] * bool(ws)


def components(rows, percent=75):
    """{text: (set size, smallest id reachable)}, comparing all pairs of texts."""
    ids = {}
    for doc_id, text in rows:
        if doc_id is not None:
            ids.setdefault(text, []).append(doc_id)
    sets = {text: frozenset(shingles(words(text))) for text in ids}
    parent = {doc_id: doc_id for members in ids.values() for doc_id in members}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    texts = [t for t in ids if sets[t]]
    for i, text in enumerate(texts):
        for member in ids[text]:
            join(ids[text][0], member)
        for other in texts[:i]:
            a, b = sets[text], sets[other]
            if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    join(ids[text][0], ids[other][0])
    return {text: (len(sets[text]), root(members[0])) for text, members in ids.items()}


def leaks(docs, items, percent=75, width=5):
    """{(doc, item): [best similarity, windows, first word]} over all item-sized windows."""
    out = {}
    known = [(i, words(t)) for i, t in items if i is not None and words(t)]
    bags = [(i, iw, min(width, len(iw)), Counter(shingles(iw, min(width, len(iw))))) for i, iw in known]
    for doc_id, text in docs:
        ws = words(text)
        own_sets = {w: set(shingles(ws, w)) for w in range(1, width + 1)}
        for item_id, iw, w, bag in bags:
            if doc_id is None or own_sets[w].isdisjoint(bag):
                continue
            for start in range(max(1, len(ws) - len(iw) + 1)):
                part = ws[start : start + len(iw)]
                if len(part) < w:
                    continue
                own = Counter(shingles(part, w))
                shared, all_ = sum((bag & own).values()), sum((bag | own).values())
                if 100 * shared >= percent * all_:
                    seen = out.setdefault((doc_id, item_id), [0, 0, start])
                    seen[0], seen[1] = max(seen[0], shared / all_), seen[1] + 1
    return out
