"""License detection with ordered signature rules.

A text is reduced to its words (A-Z lower-cased; digits, letters and all
characters from U+0080 on). Rules are regexes over that word string, built from
the hand-written license families and phrase templates below plus a list of
single signatures. Two gates keep them off most texts: a text without any of
``ANCHORS`` is never looked at, and a rule runs only on texts that contain its
keyword. Overlaps are resolved by priority and containment: a detection
goes when one of an equal or stronger priority contains it (of equal spans, the
one with the smaller priority number, then the earlier rule, stays).

Everything is DataFrame work: the rules are a table of fixed size joined
to the (few) keyword hits; detections are spans of one document each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adsift.llm.common import ascii_lower, row_key, text_of

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases of the contract and their labels.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

GRANT_WORDS = ["licensed", "released", "distributed", "published", "available", "provided", "offered", "covered"]
GRANT_LINKS = ["under", "by", "according to"]

#: Every rule's matches contain one of these ("licensed" has the first).
ANCHORS = ["licen", "copyright", "public domain", "rights reserved", "copyleft", "redistribution and use",
           "permission is hereby granted", "permission to use",
           *[f"{g} {link} " for g in GRANT_WORDS[1:] for link in GRANT_LINKS]]

# (label, keyword gate that every match of the name contains (a label has a row for each gate), name as a regex over words, SPDX identifier as words)
FAMILIES = [
    ("mit", "mit", r"mit( x11| expat)?", "mit"),
    ("mit-0", "mit", r"mit no attribution", "mit 0"),
    ("apache-1.0", "apache", r"apache( software)?( license)?( version)? 1 0", "apache 1 0"),
    ("apache-1.1", "apache", r"apache( software)?( license)?( version)? 1 1", "apache 1 1"),
    ("apache-2.0", "apache", r"apache( software)?( license)?( version| v)? ?2( 0)?", "apache 2 0"),
    ("gpl-1.0", "general public", r"(gnu )?general public license( version| v)? ?1( 0)?", "gpl 1 0( only| or later)?"),
    ("gpl-2.0", "general public", r"(gnu )?general public license( version| v)? ?2( 0)?", "gpl 2 0( only| or later)?"),
    ("gpl-3.0", "general public", r"(gnu )?general public license( version| v)? ?3( 0)?", "gpl 3 0( only| or later)?"),
    ("lgpl-2.0", "library", r"(gnu )?library general public( license)?( version| v)? ?2( 0)?", "lgpl 2 0( only| or later)?"),
    ("lgpl-2.1", "lesser", r"(gnu )?lesser general public( license)?( version| v)? ?2 1", "lgpl 2 1( only| or later)?"),
    ("lgpl-3.0", "lesser", r"(gnu )?lesser general public( license)?( version| v)? ?3( 0)?", "lgpl 3 0( only| or later)?"),
    ("agpl-3.0", "affero", r"(gnu )?affero general public( license)?( version| v)?( ?3( 0)?)?", "agpl 3 0( only| or later)?"),
    ("gfdl-1.3", "free documentation", r"(gnu )?free documentation license( version| v)?( ?1 3)?", "gfdl 1 3( only| or later)?"),
    ("bsd-2-clause", "bsd", r"(simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", r"(zero clause bsd|bsd zero clause|0bsd)", "0bsd"),
    ("isc", "isc", r"isc", "isc"),
    ("zlib", "zlib", r"zlib( libpng)?", "zlib"),
    ("libpng", "libpng", r"libpng( license)?( version 2)?", "libpng 2 0"),
    ("bsl-1.0", "boost", r"boost( software)?( license)?( version)?( 1 0)?", "bsl 1 0"),
    ("mpl-1.0", "mozilla", r"mozilla public( license)?( version| v)? ?1( 0)?", "mpl 1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public( license)?( version| v)? ?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public( license)?( version| v)? ?2( 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public( license)?( version| v)? ?1( 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public( license)?( version| v)? ?2( 0)?", "epl 2 0"),
    ("cddl-1.0", "common development", r"common development and distribution( license)?( version)?( 1 0)?", "cddl 1 0"),
    ("cddl-1.1", "common development", r"common development and distribution( license)?( version)? 1 1", "cddl 1 1"),
    ("cpl-1.0", "common public", r"common public( license)?( version)?( 1 0)?", "cpl 1 0"),
    ("cpal-1.0", "common public attribution", r"common public attribution( license)?( version)?( 1 0)?", "cpal 1 0"),
    ("ipl-1.0", "ibm", r"ibm public( license)?( version)?( 1 0)?", "ipl 1 0"),
    ("artistic-1.0", "artistic", r"artistic( license)?( version)? 1( 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic( license)?( version)? 2( 0)?", "artistic 2 0"),
    ("eupl-1.1", "european union", r"european union public( licen[cs]e)?( version| v)? ?1 1", "eupl 1 1"),
    ("eupl-1.2", "european union", r"european union public( licen[cs]e)?( version| v)? ?1 2", "eupl 1 2"),
    ("osl-3.0", "open software", r"open software( license)?( version| v)? ?3( 0)?", "osl 3 0"),
    ("afl-3.0", "academic free", r"academic free( license)?( version| v)? ?3( 0)?", "afl 3 0"),
    ("ecl-2.0", "educational community", r"educational community( license)?( version)?( 2 0)?", "ecl 2 0"),
    ("ms-pl", "microsoft", r"microsoft public", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal", "ms rl"),
    ("ncsa", "ncsa", r"(university of illinois )?(illinois )?ncsa( open source)?", "ncsa"),
    ("postgresql", "postgresql", r"postgresql", "postgresql"),
    ("python-2.0", "python", r"(python software foundation|python)( license)?( version 2)?", "(python|psf) 2 0"),
    ("python-2.0", "psf", r"psf( license)?( version 2)?", "(python|psf) 2 0"),
    ("php-3.01", "php", r"php( license)?( version)?( 3 01)?", "php 3 01"),
    ("ruby", "ruby", r"ruby", "ruby"),
    ("vim", "vim", r"vim", "vim"),
    ("w3c", "w3c", r"w3c( software)?( notice and)?", "w3c"),
    ("x11", "x11", r"x11", "x11"),
    ("curl", "curl", r"curl", "curl"),
    ("openssl", "openssl", r"openssl", "openssl"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("unlicense", "unlicense", r"(the )?unlicense", "unlicense"),
    ("upl-1.0", "universal permissive", r"universal permissive( license)?( version| v)?( 1 0)?", "upl 1 0"),
    ("ofl-1.1", "open font", r"(sil )?open font( license)?( version)?( 1 1)?", "ofl 1 1"),
    ("odbl-1.0", "open database", r"open (data commons open )?database( license)?( v?1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution( license)?( v?1 0)?", "odc by 1 0"),
    ("pddl-1.0", "open data commons", r"open data commons public domain dedication( and license)?", "pddl 1 0"),
    ("cc0-1.0", "cc0", r"(creative commons )?cc0( 1 0)?( universal)?", "cc0 1 0"),
    ("cc-by-2.0", "cc by", r"cc by( version)? 2 0", "cc by 2 0"),
    ("cc-by-2.0", "creative commons", r"creative commons attribution( version)? 2 0", "cc by 2 0"),
    ("cc-by-3.0", "cc by", r"cc by( version)? 3 0", "cc by 3 0"),
    ("cc-by-3.0", "creative commons", r"creative commons attribution( version)? 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by( version)? 4 0", "cc by 4 0"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution( version)? 4 0", "cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa", r"cc by sa( version)? 3 0", "cc by sa 3 0"),
    ("cc-by-sa-3.0", "creative commons", r"creative commons attribution share ?alike( version)? 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa( version)? 4 0", "cc by sa 4 0"),
    ("cc-by-sa-4.0", "creative commons", r"creative commons attribution share ?alike( version)? 4 0", "cc by sa 4 0"),
    ("cc-by-nc-3.0", "by nc", r"cc by nc 3 0", "cc by nc 3 0"),
    ("cc-by-nc-4.0", "by nc", r"cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "by nd", r"cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "by nc sa", r"cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "by nc nd", r"cc by nc nd 4 0", "cc by nc nd 4 0"),
    ("openrail", "rail", r"(creativeml |bigscience |bigcode )?open ?rail( m)?", "openrail"),
]

GRANT = f"({'|'.join(GRANT_WORDS)}) ({'|'.join(GRANT_LINKS)})"

# (template over a family's name and identifier, priority, confidence); a smaller priority is stronger
TEMPLATES = [
    (r"spdx license identifier {spdx}", 1, 1.0),
    (GRANT + r" (the |a )?(terms of |conditions of |terms and conditions of )?(the |a )?{name}"
             r"( software| public)?( licen[cs]e)?", 2, 0.95),
    (r"{name}( software| public| style)? licen[cs]e( agreement| text)?", 3, 0.8),
    (r"licen[cs]e( is| name| type)? {spdx}", 3, 0.75),
]

# (label, keyword, regex, priority, confidence)
SIGNATURES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 1, 1.0),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 1, 1.0),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms( with or without modification)?", 1, 1.0),
    ("bsd", "bsd", r"bsd( style)? licen[cs]e", 4, 0.7),
    ("gpl", "general public", r"(gnu )?general public licen[cs]e", 4, 0.8),
    ("lgpl", "lesser", r"(gnu )?lesser general public licen[cs]e", 4, 0.8),
    ("apache", "apache", r"apache( software)? licen[cs]e", 4, 0.8),
    # Up to the last "license" that only words of ASCII letters and digits lead to. A character class, not a repeated
    # group: for each turn of a group Java's matcher calls itself, and a long text would end its stack.
    ("cc-by", "creative commons", r"creative commons attribution( [0-9a-z ]*)? licen[cs]e", 4, 0.7),
    ("cc", "creative commons", r"creative commons licen[cs]e", 5, 0.5),
    ("public-domain", "public domain", r"(dedicated to|placed in|released into|in) the public domain", 4, 0.7),
    ("proprietary", "rights reserved", r"all rights reserved", 5, 0.4),
    ("proprietary", "proprietary", r"proprietary (and confidential )?licen[cs]e", 4, 0.6),
    ("commercial", "commercial", r"commercial licen[cs]e", 5, 0.4),
    ("copyleft", "copyleft", r"copyleft", 5, 0.4),
    ("copyright", "copyright", r"copyright( c)? (19|20)[0-9][0-9]", 6, 0.2),
    ("unknown", "licensed under", r"licensed under", 6, 0.2),
]


def build_rules() -> list[tuple[int, str, str, str, int, float]]:
    """(rule number, label, keyword, regex, priority, confidence); matches are
    whole words: the word string has a space on either side of every word."""
    rules, by_label = [], set()
    for template, priority, confidence in TEMPLATES:
        for label, keyword, name, spdx in FAMILIES:
            by_id = "{spdx}" in template
            if by_id and (template, label) in by_label:
                continue
            by_label.add((template, label))
            gate = "spdx license identifier" if template.startswith("spdx") else ("licen" if by_id else keyword)
            rules.append((label, gate, template.replace("{name}", name).replace("{spdx}", spdx), priority, confidence))
    rules += SIGNATURES
    return [(i, label, gate, f"(?<= ){regex}(?= )", priority, confidence)
            for i, (label, gate, regex, priority, confidence) in enumerate(rules)]


def rules_table(spark: SparkSession) -> DataFrame:
    """The rules; their number does not depend on the data."""
    return spark.createDataFrame(build_rules(), "rule int, label string, keyword string, regex string, "
                                                "priority int, confidence double")


def word_string(text: Column) -> Column:
    """The words of a text, separated by single spaces."""
    return F.btrim(F.regexp_replace(ascii_lower(text), NOT_WORD, " "))


def _any(c: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def raw_anchors() -> str:
    """A regex that finds every anchor in a lower-cased text whose words are not yet separated by single spaces."""
    links = "|".join(link.split()[0] for link in GRANT_LINKS)
    first = [a.split()[0] for a in ANCHORS if a.split()[0] not in GRANT_WORDS]
    return "|".join([*dict.fromkeys(first), f"({'|'.join(GRANT_WORDS[1:])}){NOT_WORD}({links})"])


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All surviving detections: ``id, row_hash, label, rule, priority,
    confidence, start_word, end_word`` (end exclusive), one per document and span.
    Repeated rows (same id and text) count once."""
    spark = docs.sparkSession
    text = text_of(text_col)
    gated = (docs.select(F.col(id_col).alias("id"), row_key(text).alias("row_hash"), text.alias("full_text"))
             .filter(F.lower("full_text").rlike(raw_anchors()))
             .select("id", "row_hash", F.concat(F.lit(" "), word_string(F.col("full_text")), F.lit(" ")).alias("words"))
             .filter(_any(F.col("words"), ANCHORS)))
    rules = rules_table(spark)
    keywords = sorted({r[2] for r in build_rules()})
    hits = gated.select("*", F.explode(F.filter(F.array(*[F.lit(k) for k in keywords]),
                                                lambda k: F.contains(F.col("words"), k))).alias("keyword"))
    # The rules are of fixed size; broadcast, they are tried in the tasks that read the texts.
    found = (hits.join(F.broadcast(rules), "keyword")
             .select("id", "row_hash", "rule", "label", "priority", "confidence", "words", "regex",
                     F.regexp_extract_all("words", F.col("regex"), F.lit(0)).alias("matches"))
             .filter(F.size("matches") > 0))
    pieces = found.select("id", "row_hash", "rule", "label", "priority", "confidence", F.posexplode(
        F.arrays_zip(F.col("matches").alias("match"),
                     F.slice(F.split("words", F.col("regex"), -1), F.lit(1), F.size("matches")).alias("gap"))))
    before = W.partitionBy("id", "row_hash", "rule").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    spaces = lambda s: F.char_length(s) - F.char_length(F.replace(s, F.lit(" "), F.lit("")))
    # Only counts are exchanged, not the words between matches.
    counted = pieces.select("id", "row_hash", "rule", "label", "priority", "confidence", "pos",
                            spaces("col.gap").alias("gap"), spaces("col.match").alias("match")).distinct()
    spans = (counted.select(
        "id", "row_hash", "rule", "label", "priority", "confidence",
        # Each gap ends with the space before a match and holds one space a word; a match holds one less than words.
        (F.coalesce(F.sum(F.col("gap") + F.col("match")).over(before), F.lit(0)) + F.col("gap") - 1).cast("long").alias("start_word"),
        (F.col("match") + 1).alias("length"))
        .select("id", "row_hash", "rule", "label", "priority", "confidence", "start_word",
                (F.col("start_word") + F.col("length")).alias("end_word")))
    order = W.partitionBy("id", "row_hash").orderBy("start_word", F.desc("end_word"), "priority", "rule")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    levels = sorted({r[4] for r in build_rules()})
    contained = F.lit(False)
    for level in levels:
        reach = F.max(F.when(F.col("priority") <= level, F.col("end_word"))).over(earlier)
        contained = contained | ((F.col("priority") == level) & F.coalesce(reach >= F.col("end_word"), F.lit(False)))
    return spans.withColumn("contained", contained).filter(~F.col("contained")).drop("contained")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base phrase places and license labels per row.

    Returns per row: ``row`` (struct of all input columns), ``n_words``,
    ``n_base`` (places of all base phrases), ``first_word`` and ``last_word``
    (smallest and largest start, null without a place), ``base_labels``,
    ``labels`` (base and detected; sorted, comma-joined), ``score`` (the highest
    confidence of a detection, at least 0.8 with a base phrase, else 0) and
    ``spans`` (``label:start:end`` of surviving detections by start, in words).
    Null text has no words. Ids may be null or repeat.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("full_text"))
    rows = rows.select("row", "id", row_key(F.col("full_text")).alias("row_hash"),
                       word_string(F.col("full_text")).alias("words"))
    padded = F.concat(F.lit(" "), F.col("words"), F.lit(" "))
    any_base = _any(padded, [f" {p} " for p, _ in BASE_PHRASES])
    rows = rows.select(
        "row", "id", "row_hash",
        F.when(F.col("words") == "", 0).otherwise(
            F.char_length("words") - F.char_length(F.replace("words", F.lit(" "), F.lit(""))) + 1)
        .cast("long").alias("n_words"),
        F.when(any_base, F.split("words", " ")).alias("list"))

    def starts(phrase: str) -> Column:
        parts = phrase.split()
        same = lambda i: [F.col("list")[i + k] == w for k, w in enumerate(parts)]

        def at(i):
            out = F.lit(True)
            for c in same(i):
                out = out & c
            return out
        return F.when(F.size("list") >= len(parts),
                      F.filter(F.sequence(F.lit(0), F.size("list") - len(parts)), at)) \
            .otherwise(F.array().cast("array<int>"))

    rows = rows.select("row", "id", "row_hash", "n_words",
                       *[F.when(F.col("list").isNotNull(), starts(p)).alias(f"at_{i}")
                         for i, (p, _) in enumerate(BASE_PHRASES)])
    cols = [f"at_{i}" for i in range(len(BASE_PHRASES))]
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label))
                                     for c, (_, label) in zip(cols, BASE_PHRASES, strict=True)]))
    rows = rows.select(
        "row", "id", "row_hash", "n_words",
        F.coalesce(sum((F.size(c) for c in cols[1:]), F.size(cols[0])), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[F.array_min(c) for c in cols]).cast("long").alias("first_word"),
        F.greatest(*[F.array_max(c) for c in cols]).cast("long").alias("last_word"),
        F.when(F.col(cols[0]).isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(base)).alias("base"))
    per_doc = (detections(docs, id_col, text_col).groupBy(F.col("id").alias("d_id"), F.col("row_hash").alias("d_hash"))
               .agg(F.collect_set("label").alias("found"), F.max("confidence").alias("best"),
                    F.sort_array(F.collect_list(F.struct("start_word", "end_word", "label"))).alias("spans")))
    joined = rows.join(per_doc, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("row_hash") == F.col("d_hash")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    floor = F.when(F.size("base") > 0, 0.8).otherwise(0.0)
    return joined.select(
        "row", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), floor).alias("score"),
        F.array_join(F.transform(F.coalesce("spans", F.array().cast(
            "array<struct<start_word:bigint,end_word:bigint,label:string>>")),
            lambda s: F.concat_ws(":", s["label"], s["start_word"], s["end_word"])), ",").alias("spans"))
