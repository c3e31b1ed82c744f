"""Small frames with the awkward rows every operator must take."""

import random

WORDS = "the of and river stone light paper green quick slow under over house table window".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 30)) for _ in range(n))


def awkward_texts() -> list:
    """Null, empty, blank, short, repeated, odd white space, very long, not ASCII."""
    long = " ".join(prose(i, 500) for i in range(40))
    return [None, "", " \t\n\x0b\x0c\r ", "one", "One  two\nthree\tfour", "a b c a b c a b c", "a b c a b c a b c",
            "ÄÖÜ ÉÀ straße Straße é x ▁y", "x\n\nx\nX\n  x\n", "#tag $5 50% a|b <i> & *", long, prose(1, 80),
            prose(1, 80), prose(2, 60) + "\n" + prose(2, 60)]


def awkward_docs(spark, extra: str = ""):
    """The texts above with ids, null ids, repeated ids, sources with and without a
    name, and columns whose names operators use themselves."""
    rows = [(i, t, ["a", None, "b", "c"][i % 4]) for i, t in enumerate(awkward_texts())]
    rows += [(None, prose(1, 80), "a"), (None, None, None), (3, "one", "c"), (3, "one", "c"), (4, "another text", "a")]
    clash = ["size", "key", "kept", "n_words", "row", "word", "shard", "_key", "component_id", "label"]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([r + ("x",) * len(clash) for r in rows], schema)


def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")
