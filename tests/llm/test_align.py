"""Token alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import rows, table
from tokenizers import Tokenizer

from legwork.llm import align

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts):
    side_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = align.byte_letters()

    def ends(pieces):
        at, out = 0, []
        for piece in pieces:
            at += len(piece)
            out.append(at)
        return out

    counts, held = Counter(), []
    for doc_id, text in texts:
        a = b = []
        if text:
            a = side_a.encode(" " + text, add_special_tokens=False).ids
            b = side_b.encode(text)
            bytes_a = [bytes(letters[c] for c in side_a.id_to_token(i)) for i in a]
            bytes_b = [
                bytes([int(side_b.id_to_piece(i)[3:5], 16)]) if side_b.is_byte(i)
                else side_b.id_to_piece(i).replace("▁", " ").encode() for i in b
            ]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                a = b = []
        if not a:
            held.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        links = [(x, y) for x, e in zip(a, ends_a) for y in [b[ends_b.index(e)] if e in set(ends_b) else None] if y is not None]
        counts.update(links)
        groups, begin_a, begin_b = [], 0, 0
        for stop in sorted(set(ends_a) & set(ends_b)):
            stop_a, stop_b = ends_a.index(stop) + 1, ends_b.index(stop) + 1
            groups.append(",".join(map(str, a[begin_a:stop_a])) + "|" + ",".join(map(str, b[begin_b:stop_b])))
            begin_a, begin_b = stop_a, stop_b
        held.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted((
        (i, n_a, n_b, n, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for i, n_a, n_b, n, links, sha in held), key=repr), counts, top


def texts():
    out = [(r[0], r[1] if r[0] != 68 else r[1][:9000]) for r in rows()]
    out += [(200, "</s><|endoftext|> <unk> [INST]"), (201, "漢字 é😀 ▁ x"), (202, "  two  spaces\n\n\ttab "), (203, "<0x0A>"), (204, "\x00nul")]
    return out


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("links", "fan"), [(2_000_000, 64), (40, 2)])
def test_alignment_like_brute_force(spark, monkeypatch, links, fan):
    monkeypatch.setattr(align, "CHUNK_LINKS", links)
    monkeypatch.setattr(align, "FAN", fan)
    if fan == 2:  # many chunks, slices, merge levels and blocks
        monkeypatch.setattr(align, "BLOCK", 7)
        monkeypatch.setattr(align, "ROW_BLOCKS", 2)
    data = texts()
    df = table(spark, [(i, t, "own", "own", 0) for i, t in data]).withColumnsRenamed({"lang": "part", "source": "chunk", "n_chars": "blocks"})
    want, counts, top = brute(data)
    found, totals, a_bits = align.align_tokens(df)
    assert result(found) == want
    pairs = {(r["a"], r["b"]): (r["links"], r["best"]) for r in align.pair_table(totals, a_bits, 15).collect()}
    assert pairs == {p: (n, n == top[p[1]]) for p, n in counts.items()}


def test_alignment_of_nothing(spark):
    found, _, _ = align.align_tokens(spark.createDataFrame([], "doc_id string, text string"))
    assert result(found) == []
    found, _, _ = align.align_tokens(spark.createDataFrame([("x", None), ("x", "")], "doc_id string, text string"))
    assert result(found) == [("x", 0, 0, 0, 0, 0, 0, "")] * 2


def test_merge_of_runs_that_share_keys():
    rng = random.Random(5)
    runs = [sorted(rng.randrange(60) for _ in range(rng.randrange(0, 90))) for _ in range(9)]

    def blocks(run):
        for i in range(0, len(run), 4):
            part = np.array(run[i : i + 4])
            yield [part, np.ones(len(part), np.int64)]

    keys = [np.concatenate(c) for c in zip(*align.summed([blocks(r) for r in runs]))]
    assert dict(zip(*(k.tolist() for k in keys))) == Counter(x for r in runs for x in r)
    packed = [align.unpack_block(b, 2) for b in align.pack_blocks(keys)]
    assert all((np.concatenate(c) == k).all() for c, k in zip(zip(*packed), keys))
