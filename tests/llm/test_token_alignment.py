from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rainloom.llm import common, token_alignment
from tests.llm.conftest import HARD_TEXTS, SF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spans(pieces):
    at, found = 0, []
    for p in pieces:
        found.append((at, at + len(p)))
        at += len(p)
    return found


def encoders():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}

    def both(text):
        if not text:
            return [], [], [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        px = [bytes(of[c] for c in a.id_to_token(i)) for i in x]
        py = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        raw = (" " + text).encode()
        return (x, y, px, py) if b"".join(px) == raw and b"".join(py) == raw else ([], [], [], [])

    return both


def brute(rows):
    both, docs = encoders(), []
    for key, text in rows:
        x, y, px, py = both(text)
        sx, sy = spans(px), spans(py)
        ends = sorted({e for _, e in sx} & {e for _, e in sy})
        links, j0 = [], 0
        for i, (s, e) in enumerate(sx):
            while j0 < len(sy) and sy[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sy) and sy[j][0] < e:
                links.append((x[i], y[j]))
                j += 1
        groups, start, i, j = [], 0, 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(sx) and sx[i][1] <= end:
                ga.append(str(x[i]))
                i += 1
            while j < len(sy) and sy[j][1] <= end:
                gb.append(str(y[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        docs.append((key, len(x), len(y), len(ends), links, ";".join(groups)))
    counts = Counter(link for d in docs for link in d[4])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    pairs = {}
    for n, d in enumerate(docs):
        for link in d[4]:
            pairs.setdefault(link, set()).add(n)
    result = [(k, a, b, g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
               hashlib.sha256(text.encode()).hexdigest() if a else "") for k, a, b, g, links, text in docs]
    return sorted(result, key=str), {p: (len(d), counts[p]) for p, d in pairs.items()}


def result_of(docs):
    return sorted((tuple(r) for r in token_alignment.align(docs, A, B).collect()), key=str)


TRICKY = [(20, " lead and trail "), (21, "x<s>y <unk> <|endoftext|> </s>"), (22, "▁bar a▁b"), (23, "tab\tnew\nline\r\n\r\n  two"),
          (24, "中文字 😀👩‍👩‍👧 ﬁﬀ ½"), (25, "a b c　d"), (26, "\x00\x01nul"), (27, "é é ñ"), (28, "<0x41> 0x41"),
          (29, "the the the the " * 300)]


def test_equal_brute_force_on_documents(spark):
    docs = common.documents(spark, SF)
    assert result_of(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])[0]


@pytest.mark.parametrize("limits", [(1 << 15, 1 << 20), (3, 1 << 20), (1 << 15, 40)])
def test_hard_rows_in_blocks(spark, docs_of, limits, monkeypatch):
    inverted = token_alignment.inverted
    monkeypatch.setattr(token_alignment, "inverted", lambda *a: inverted(*a, *limits))
    rows = HARD_TEXTS + TRICKY
    docs = docs_of(rows)
    assert result_of(docs) == brute(rows)[0]
    assert result_of(docs.limit(0)) == []


def test_pair_counts_from_bitmaps(spark, docs_of):
    rows = HARD_TEXTS + TRICKY
    held = token_alignment.held_pairs(token_alignment.inverted(docs_of(rows).coalesce(2), A, B, 4))
    got = {(r["pair"] >> token_alignment.B_BITS, r["pair"] & ((1 << token_alignment.B_BITS) - 1)): (r["n_docs"], r["n_links"])
           for r in token_alignment.pair_counts(held).collect()}
    assert got == brute(rows)[1]


@pytest.mark.parametrize("n_docs", [1, 7, 64, 1000])
def test_planes_give_back_what_went_in(n_docs):
    rng = np.random.default_rng(n_docs)
    pairs, places = rng.integers(0, 40, 5000) ** 2, rng.integers(0, n_docs, 5000)
    distinct, sizes, sparse, dense = token_alignment.pack(pairs, places, n_docs)
    times = Counter()
    for plane, stored in enumerate(zip(sizes, sparse, dense)):
        for row, place in zip(*token_alignment.unpack(*stored, n_docs)):
            times[int(distinct[row]), int(place)] += 1 << plane
    assert times == Counter(zip(pairs.tolist(), places.tolist()))
    assert token_alignment.pack(pairs[:0], places[:0], n_docs)[1:] == ([], [], [])
