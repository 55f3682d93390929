"""Plain versions of operators on lists."""

import re


def shingle_set(text, width=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def similar(a, b, least=85):
    return bool(a and b) and 100 * len(a & b) >= least * len(a | b)


def near_duplicate_rows(docs, least=85):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    sizes = sorted(range(len(docs)), key=lambda i: len(sets[i]))
    for x, i in enumerate(sizes):
        for j in sizes[x + 1 :]:
            if 100 * len(sets[i]) < least * len(sets[j]):
                break
            if find(i) != find(j) and similar(sets[i], sets[j], least):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return [(doc_id, len(sets[i]), ids.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(docs)]
