"""Small tables and slow, plain versions of what the operators compute."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, **columns):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (
            i,
            t,
            columns.get("lang", ["en"] * len(texts))[k],
            columns.get("source", ["s"] * len(texts))[k],
            None if t is None else len(t),
        )
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def union_find(nodes, links):
    """The smallest node each node reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
