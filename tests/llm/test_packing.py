import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voltdrift.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_first_fit_decreasing_matches_a_scan():
    r = random.Random(9)
    lengths = [r.randrange(1, 101) for _ in range(400)]
    bins, expected = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, room in enumerate(bins) if room >= lengths[i]), len(bins))
        if at == len(bins):
            bins.append(100)
        bins[at] -= lengths[i]
        expected[i] = at
    assert p.first_fit_decreasing(lengths, 100) == expected
    assert p.first_fit_decreasing([], 100) == [] and p.first_fit_decreasing([100], 100) == [0]


def test_ids_by_word_are_the_ids_of_the_text():
    texts = ["", "A b\tc\nd  e", "Été É  \u0085x", "it's 'S 12.5%!! <|endoftext|> <|ENDOFTEXT|>", "İ ΣσΣ \U0001f600a", "x" * 300, "a\x1cb\x00c", "\ue000", "a\ue000b \ue000 c \ue000\ue000", "e\u0301 \u0301e \u3000x"]
    words, plain = p.WordIds(PATH, cache=3), Tokenizer.from_file(PATH)
    for text in texts * 2:
        assert np.frombuffer(words.of(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length, group", [(64, 5), (4096, 4000)])
def test_pieces_make_up_the_documents(spark, length, group):
    r = random.Random(2)
    docs = [(i, " ".join(f"word{r.randrange(99)}" for _ in range(r.randrange(60)))) for i in range(90)]
    docs += [(200, None), (201, ""), docs[0], (None, "no id"), (202, "very long " * 3000)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, length int").repartition(3)
    rows = p.packed(frame, length=length, group_size=group).collect()
    plain, expected, found, sequences = Tokenizer.from_file(PATH), [], [], defaultdict(list)
    for i, text in docs:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected += [(i, s, len(ids[s : s + length]), zlib.crc32(ids[s : s + length].tobytes()), len(ids)) for s in range(0, len(ids), length)]
    for row in rows:
        found.append((row.doc_id, row.start, row.length, row.ids_crc32, row.doc_tokens))
        sequences[row.sequence_id].append((row.offset, row.length))
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    for pieces in sequences.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= length
    if group > 1000:
        assert len(sequences) <= sum(x[2] for x in found) / length * 1.2 + 1


def test_nothing(spark):
    assert p.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
