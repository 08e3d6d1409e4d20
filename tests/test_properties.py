"""Randomised checks of the Java-compatible helpers against a Python model."""

import random

from adsift.functions import form_complete, java_split, tag_value


def java_split_model(s, d):
    """java.lang.String.split with a literal delimiter and limit 0."""
    if s is None:
        return None
    if d not in s:
        return [s]
    parts = s.split(d)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def rand_strings(tokens, n, max_len, seed):
    rnd = random.Random(seed)
    out = {"", None}
    while len(out) < n:
        out.add("".join(rnd.choice(tokens) for _ in range(rnd.randint(0, max_len))))
    return sorted(out, key=lambda x: (x is None, x))


def test_java_split_single_char(spark):
    data = rand_strings(["a", "b", ":", ":"], 1500, 9, 1)
    df = spark.createDataFrame([(s,) for s in data], "s string")
    got = [r[0] for r in df.select(java_split("s", ":")).collect()]
    assert got == [java_split_model(s, ":") for s in data]


def test_java_split_multi_char(spark):
    data = rand_strings(["a", "=", "&", "school=", "schoo"], 1500, 6, 2)
    df = spark.createDataFrame([(s,) for s in data], "s string")
    got = [r[0] for r in df.select(java_split("s", "school=")).collect()]
    assert got == [java_split_model(s, "school=") for s in data]


def test_form_complete_model(spark):
    data = rand_strings(["a", "=", "&", "school=", "x"], 1500, 6, 3)
    df = spark.createDataFrame([(s,) for s in data], "s string")
    got = [r[0] for r in df.select(form_complete("s")).collect()]

    def model(s):
        if s is None:
            return False
        p = java_split_model(s, "school=")
        return len(p) > 1 and "=&" not in p[0]
    assert got == [model(s) for s in data]


def test_tag_value_model(spark):
    rnd = random.Random(4)
    atoms = ["vendor:a", "vendor:b", "vendor:", "vendor:x:y", ":vendor", "vendor", "abtest:1", "x", "",
             "vendor:c:", "vendor:d::", "vendor::e", "vendor:f\n", "vendor:g:\n", "vendorx:h", "vendor:i j",
             "vendor:k\n:", ":", "::", None]
    arrays = [[rnd.choice(atoms) for _ in range(rnd.randint(0, 5))] for _ in range(800)] + [None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, tags array<string>")
    got = [r[0] for r in df.orderBy("i").select(tag_value("tags", "vendor")).collect()]

    def model(tags):
        val = ""
        for t in tags or []:
            p = java_split_model(t, ":") or []
            if len(p) == 2 and p[0] == "vendor":
                val = p[1]
        return val
    assert got == [model(a) for a in arrays]
