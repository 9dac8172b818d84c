import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import docs_frame, odd_texts
from tokenizers import Tokenizer

from pitlane.llm import queries
from pitlane.llm.shared import text_chunks
from pitlane.llm.token_counts import CHUNK, START, STATES, Counter, compile_tokenizer, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return Counter(compile_tokenizer(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counts(counter, texts):
    out = []
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        out += counter.count_texts(data, offsets).tolist()
    return out


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def random_texts(seed, n):
    rng = random.Random(seed)
    bits = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'r", "'v", "'l", "'", "''", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "a", "the", "Zebra", "éà", "中文", "́", "1", "23", "²", "٤",
            "!", "...", "$%", "<|endoftext|>", "<|endoftext", "|>", "\U0001F600", "\U0001D400", "ſ", "​", "İ", "'S", "anti", "ing"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_random_texts_as_the_library_counts(counter, library):
    texts = random_texts(1, 4000)
    got, want = counts(counter, texts), wanted(library, texts)
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w][:3] == []


def test_long_pieces_and_chunk_edges(counter, library):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeinorst") for _ in range(n)) for n in (63, 64, 65, 500, 5000)]
    texts += ["x" * (CHUNK - k) + "'re you" + " " * k + "'ve" for k in range(6)] + [" " * 600, "\n" * 700 + "a", "a'" * 400, "<|endoftext|>" * 50]
    assert counts(counter, texts) == wanted(library, texts)


def test_classes_match_the_library_everywhere(counter, library):
    texts = [chr(c) + "a" + chr(c) + "1" + chr(c) + "!" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    assert counts(counter, texts) == wanted(library, texts)


def test_prefix_scan_equals_a_sequential_run():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, STATES, (37, STATES))
    state, want = START, []
    for m in maps:
        want.append(state)
        state = m[state]
    assert Counter.first_states(maps).tolist() == want


def test_edges(spark, library):
    texts = odd_texts() + random_texts(3, 20)
    df = docs_frame(spark, enumerate(texts)).union(docs_frame(spark, [(None, "a b"), (3, "\n\n")]))
    rows = count_tokens(df, "doc_id", "text", PATH).collect()
    assert len(rows) == len(texts) + 2
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows}
    want = {i: (len((t or "").encode()), w, w > 1024) for (i, t), w in zip(enumerate(texts), wanted(library, texts))}
    assert {k: v for k, v in got.items() if k is not None} == want and got[None][1] == 2
    assert count_tokens(df.limit(0), "doc_id", "text", PATH).count() == 0


def test_query_on_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], wanted(library, [r.text for r in docs])))
    assert {r.doc_id: r.n_tokens for r in queries.op8_token_counts(spark, "/root/testdata/sf0.01").collect()} == want
