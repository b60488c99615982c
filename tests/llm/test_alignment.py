"""Token alignment against a plain, single-process version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import edge_docs, edge_rows, prose

from riskstream.llm import alignment as al


@pytest.fixture(scope="module")
def known():
    return al.Tokenizers(*map(al.read_file, al.default_files()))


def plain_tokens(text):
    """[(id, start, end)] by both libraries' own encoders, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = al.default_files()
    if not hasattr(plain_tokens, "a"):
        plain_tokens.a = Tokenizer.from_file(a_path)
        plain_tokens.a.encode_special_tokens = True
        plain_tokens.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    back = al.byte_of_char()
    a, b = plain_tokens.a, plain_tokens.b
    a_bytes = [(i, bytes(back[c] for c in a.id_to_token(i)))
               for i in a.encode(" " + text, add_special_tokens=False).ids]
    b_bytes = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
               for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
    out = []
    for side in (a_bytes, b_bytes):
        if b"".join(t for _, t in side) != (" " + text).encode():
            return None
        at, spans = 0, []
        for i, t in side:
            spans.append((i, at, at + len(t)))
            at += len(t)
        out.append(spans)
    return out


def plain(rows):
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        got = plain_tokens(text) if text else None
        if got is None:
            docs.append((doc_id, [], [], [], []))
            continue
        a, b = got
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, lo = [], 0
        for hi in cuts:
            groups.append([[x[0] for x in side if lo < x[2] <= hi] for side in (a, b)])
            lo = hi
        links, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        pairs.update(links)
        docs.append((doc_id, a, b, groups, links))
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, groups, links in docs:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links),
                    sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links), said))
    return out


AWKWARD = ["<|endoftext|> and <s> </s>", "a▁b", "  two  spaces\n\n\ttabs  ", "é中文字😀 naïve",
           "x" * 300, "\x00\x01 nul", "don't 12345 3.14 -- ", " ", "中" * 50 + " 文" * 40]


def rows_of(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
                   for r in df.collect())


@pytest.mark.parametrize("chunk,batch", [(1 << 15, 1 << 22), (60, 500)])
def test_alignment_equals_plain(spark, chunk, batch):
    rows = [(i, t, None, None) for i, t, *_ in edge_rows() if len(t or "") < 5000]
    rows += [(100 + i, t, None, None) for i, t in enumerate(AWKWARD)]
    rows += [(200, prose(7, 900) + " a▁b " + prose(8, 50), None, None), (201, prose(9, 600), None, None)]
    docs = edge_docs(spark, rows)
    got = al.align(docs, *al.default_files(), chunk=chunk, batch_bytes=batch)
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert rows_of(got) == Counter(plain([(i, t) for i, t, *_ in rows]))


def test_empty_table(spark):
    docs = edge_docs(spark, []).filter("doc_id IS NULL")
    assert al.align(docs, *al.default_files()).count() == 0


def test_query_on_testdata(spark):
    sf = "/root/testdata/sf0.001"
    got = al.op12_fragment_alignment(spark, sf)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = Counter((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "")
                   for r in plain(docs))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups_sha256) for r in got.collect()) == want


def test_fragments_are_a_monoid(known):
    """Any cuts, any bracketing: tokens go to the range in which they end."""
    r = random.Random(3)
    text = prose(5, 60) + " unbelievably 中文字 naïveté 12345678 " + "q" * 40
    a, b = known.tokens(" " + text)
    t = al.Tokens(a, np.cumsum(known.a_len[a]), b, np.cumsum(known.b_len[b]))
    one, codes = al.fragment(t, known.digits)
    want = al.whole(one)
    for _ in range(40):
        cuts = sorted(r.sample(range(1, int(t.a_end[-1])), r.randint(0, 12)))
        parts, links, rest = [], [], t
        for c in [*cuts, int(t.a_end[-1])]:
            mine, rest = rest.upto(c)
            f, inside = al.fragment(mine, known.digits)
            parts.append(al.unpacked(al.packed(f)))
            links += inside.tolist()
        while len(parts) > 1:
            i = r.randrange(len(parts) - 1)
            parts[i:i + 2] = [al.compose(parts[i], parts[i + 1])]
        got = al.whole(al.compose(parts[0], al.Fragment()))
        assert got.closed == want.closed and got[2:6] == want[2:6]
        assert Counter(links + got.seams.tolist()) == Counter(codes.tolist() + want.seams.tolist())


def test_cuts_keep_tokens(known):
    """Encoding by chunks gives the tokens of the whole text."""
    for text in [prose(11, 500), "  lead " + prose(12, 80) + "  \n x\t" + prose(13, 90), *AWKWARD]:
        whole = known.tokens(" " + text)
        pieces = al.chunks(text, 50, True)
        assert "".join(pieces) == " " + text and all(p[0] == " " for p in pieces)
        got = [known.tokens(p) for p in pieces]
        if whole is None:
            assert None in got
        else:
            for side in (0, 1):
                assert np.array_equal(np.concatenate([g[side] for g in got]), whole[side])
