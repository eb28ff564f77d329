"""Brute-force counterparts shared by the tests."""


def groups(n, links):
    """Smallest reachable index of each of n nodes."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
TEXTS = ["alpha beta gamma delta epsilon zeta", None, "", " \t\n", "one", "alpha beta gamma delta epsilon zeta", LONG, LONG + " tail", "ÄÖ été ñandú 日本語 😀 ça va bien merci", "a b c d e f g h"]


def documents(spark, texts=TEXTS, extra=True):
    """Rows with nulls, empty and very long texts, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None, "kept", 0.5, 7) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", None, None, "kept", 0.5, 7), (None, "no id here at all", "en", "s1", None, "kept", 0.5, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, secrets string, score double, size int")
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")
