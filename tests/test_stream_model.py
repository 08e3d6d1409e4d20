"""Per-batch word count against a Python model of Java's split, on random text."""

import collections
import os
import random

from adsift.session import scratch_path
from adsift.streaming import file_line_stream, read_batches, word_count_stream
from tests.test_properties import java_split_model


def test_stream_batches_match_model(spark):
    rnd = random.Random(17)
    inbox = scratch_path(spark, "wc-model-in").replace("file:", "")
    os.makedirs(inbox)
    batches = []
    for b in range(3):
        lines = ["".join(rnd.choice(["a", "b", " ", "  ", "c "]) for _ in range(rnd.randint(0, 6)))
                 for _ in range(20)]
        lines = [ln for ln in lines if ln]          # the text source has no empty-line rows at EOF edge cases
        batches.append(lines)
        with open(os.path.join(inbox, f"{b:02d}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(inbox, f"{b:02d}.txt"), (1_700_000_000 + b, 1_700_000_000 + b))
    out, ckpt = scratch_path(spark, "wc-model-out"), scratch_path(spark, "wc-model-ckpt")
    q = word_count_stream(file_line_stream(spark, inbox, max_files_per_trigger=1), out, ckpt,
                          trigger={"availableNow": True})
    q.awaitTermination(180)
    got = collections.defaultdict(dict)
    for r in read_batches(spark, out).collect():
        got[r.batch_id][r.word] = r.n
    want = {i: dict(collections.Counter(w for ln in lines for w in java_split_model(ln, " ")))
            for i, lines in enumerate(batches)}
    assert {k: v for k, v in got.items()} == {k: v for k, v in want.items() if v}
