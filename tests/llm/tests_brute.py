"""Plain-Python shingle sets for the pipeline's test."""


def grams(text, size=5):
    w = (text or "").encode().lower().split()
    n = min(size, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def similar(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)
