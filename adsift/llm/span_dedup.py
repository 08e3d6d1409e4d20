"""Substring de-duplication by sliding spans of sentences.

From every sentence of a document a run of consecutive sentences is hashed: ``span`` of them, or fewer if those already hold
``long_words`` words, so that a passage of few long sentences is a run, too. A sentence of over ``max_words`` words is cut behind
words of 7 or 14 characters: a rule on the content alone, which cuts a passage alike wherever it stands.
The hashes are grouped over all documents, and each sentence covered by a repeated run that is not the run's first
occurrence (smallest document, then position) is removed. With ``min_words``, covered sentences that stand together are
judged as one stretch: shorter ones (a footer, a signature) stay.

The runs are written once as a table and read twice: to find the repeated ones (map-side aggregation reduces a run that very many
documents share to one row a task before any shuffle), and to find their later occurrences. The repeated runs are written, too,
so that this join has an exchange on both sides and adaptive execution can split a hot run. The later occurrences are exchanged once, gathered
by document before they are laid out as sentences. Texts are shuffled once, to be rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsift.llm.common import SPACE_CHARS, ascii_lower, row_key, text_of, written

#: A sentence with what ends it; the pieces of a text, joined, are the text.
PIECE = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
#: The place before a space that follows a word of 7 or 14 characters (about every tenth).
CUT = r"(?=[ \t\x0B\f\r])(?<=(?:^|[ \t\x0B\f\r])(?:\S{7}|\S{14}))"
KEY = ["h1", "h2"]


def n_words(c: Column) -> Column:
    """Words of a trimmed text, counted by its spaces."""
    return F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit(""))) + 1


def _cut(piece: Column) -> Column:
    """A long sentence in parts that end with a word of 7 or 14 characters. (No line feed stands within a sentence.)"""
    return F.split(piece, CUT, -1)


def pieces(text: Column, max_words: int) -> Column:
    """The pieces of a text: sentences, and parts of long ones. Joined, they are the text."""
    found = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.flatten(F.transform(found, lambda p: F.when(n_words(p) > max_words, _cut(p)).otherwise(F.array(p))))


def keyed(piece: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(piece, F.lit(SPACE_CHARS)))


#: Bits for the words of each sentence of a run, in one number; larger counts are held.
WORD_BITS, MAX_COUNT = 10, 1023


def span_hashes(docs: DataFrame, id_col: str, text_col: str, span: int, long_words: int, max_words: int) -> DataFrame:
    """One row per run: ``id, row_hash, at, words`` (of its sentences, packed), ``h1, h2``. Pieces of white space alone are no sentences."""
    text = text_of(text_col)
    keys = F.filter(F.transform(pieces(text, max_words), keyed), lambda k: k != "")
    rows = (docs.filter(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("id"), row_key(text).alias("row_hash"), keys.alias("keys"))
            .select("id", "row_hash", F.transform("keys", n_words).alias("n"),
                    F.transform("keys", lambda k: F.xxhash64(k)).alias("a"),
                    F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k)).alias("b")))

    def length(first: Column, i: Column) -> Column:
        """Sentences of the run that begins with sentence ``i``; 0 if the document ends before."""
        words, out = first, F.when(first >= long_words, 1)
        for k in range(1, span - 1):
            words = words + F.get("n", i + k)
            out = out.when(words >= long_words, k + 1)
        return out.when(i + span <= F.size("n"), span).otherwise(0)

    rows = rows.select("id", "row_hash", "n", "a", "b", F.transform("n", length).alias("lengths"))

    def by_length(size: Column, of) -> Column:
        out = F.when(size == 1, of(1))
        for k in range(2, span):
            out = out.when(size == k, of(k))
        return out.otherwise(of(span))

    def run(size: Column, i: Column) -> Column:
        part = lambda c, k: [F.get(c, i + j) for j in range(k)]
        packed = lambda k: sum((F.least(x, F.lit(MAX_COUNT)).cast("bigint") * (1 << WORD_BITS * j)
                                for j, x in enumerate(part("n", k))), F.lit(0).cast("bigint"))
        return F.when(size > 0, F.struct(
            i.alias("at"), by_length(size, packed).alias("words"),
            by_length(size, lambda k: F.xxhash64(F.lit(k), *part("a", k))).alias("h1"),
            by_length(size, lambda k: F.xxhash64(F.lit(-k), *part("b", k))).alias("h2")))

    runs = F.filter(F.transform("lengths", run), lambda r: r.isNotNull())
    return rows.select("id", "row_hash", F.explode(runs).alias("run")).select("id", "row_hash", "run.*")


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 3,
                long_words: int = 20, max_words: int = 25, min_words: int = 0) -> DataFrame:
    """Remove the sentences that a later occurrence of a repeated run covers.

    Returns one row per input row: ``row`` (struct of all its columns),
    ``n_sentences``, ``n_removed`` and ``kept_text`` (the other pieces, as they
    were, in order). Every run counts, however short its sentences, unless ``min_words`` is set: then sentences that are covered
    stay where fewer words than that stand together. Overlapping occurrences within a document count; a document of under ``span``
    sentences and ``long_words`` words has no run and stays whole. Null text is empty. Rows with a null
    id stay whole and hide none of others; repeated rows (same id and text) are one document
    and get equal results. An empty table gives an empty result.
    """
    if span * WORD_BITS > 60:
        raise ValueError("a run has 6 sentences at most")
    runs = written(span_hashes(docs, id_col, text_col, span, long_words, max_words), "sentence-spans")
    repeated = written(
        runs.groupBy(*KEY).agg(F.min(F.struct("id", "at", "row_hash")).alias("first"),
                               F.max(F.struct("id", "at", "row_hash")).alias("last"))
        .filter("first != last").select(*KEY, "first"), "repeated-spans")
    later = (runs.join(repeated.hint("merge"), KEY)
             .filter(F.struct("id", "at", "row_hash") != F.col("first")))
    # The one exchange of the runs by document; what follows, up to the join with the texts, needs no other.
    runs_of = later.groupBy("id", "row_hash").agg(F.collect_set(F.struct("at", "words")).alias("runs"))
    counts = F.filter(F.array(*[F.shiftright("words", WORD_BITS * k).bitwiseAND(MAX_COUNT) for k in range(span)]), lambda n: n > 0)
    covered = (runs_of.select("id", "row_hash", F.explode("runs").alias("run")).select("id", "row_hash", "run.*")
               .select("id", "row_hash", "at", F.posexplode(counts).alias("k", "words"))
               .select("id", "row_hash", (F.col("at") + F.col("k")).alias("at"), "words").distinct())
    if min_words > 0:
        row = Window.partitionBy("id", "row_hash")
        stretch = covered.withColumn("stretch", F.col("at") - F.row_number().over(row.orderBy("at")))
        covered = (stretch.withColumn("total", F.sum("words").over(Window.partitionBy("id", "row_hash", "stretch")))
                   .filter(F.col("total") >= min_words))
    removed = covered.groupBy("id", "row_hash").agg(F.collect_list("at").alias("removed"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("id"), row_key(text).alias("row_hash"))
    joined = rows.join(removed, ["id", "row_hash"], "left")
    parts = joined.select("row", "removed", text.alias("full_text"), pieces(text, max_words).alias("pieces"))
    # Numbers of the pieces that are sentences, in order; then those of the kept pieces.
    parts = parts.select("row", "removed", "full_text", "pieces", F.filter(
        F.transform("pieces", lambda p, i: F.when(F.btrim(p, F.lit(SPACE_CHARS)) != "", i)), lambda i: i.isNotNull()).alias("sentence_at"))
    sentence_at, all_pieces = F.col("sentence_at"), F.col("pieces")
    gone = F.transform("removed", lambda k: sentence_at[k])
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_pieces) - 1), gone)
    return parts.select(
        "row", F.size(sentence_at).cast("long").alias("n_sentences"),
        F.coalesce(F.array_size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("full_text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: all_pieces[i]), "")).alias("kept_text"))
