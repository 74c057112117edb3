"""What a worker keeps between tasks, and lets go of."""

import pickle

from formloom.llm import bpe, quality, token_files
from formloom.llm.common import IDLE_TASKS, drop_idle_stores

PATH = bpe.default_path()


def test_stores_of_earlier_steps_are_dropped():
    memo, vocabulary = bpe.packed_words(PATH), bpe.vocabulary(PATH)
    for _ in range(IDLE_TASKS + 2):
        drop_idle_stores()
        quality.features("a word of the next step")
    assert bpe.packed_words(PATH) is not memo and bpe.vocabulary(PATH) is not vocabulary


def test_a_store_in_use_stays():
    memo = bpe.packed_words(PATH)
    for _ in range(4 * IDLE_TASKS + 4):
        drop_idle_stores()
        assert bpe.packed_words(PATH) is memo


def test_tasks_take_the_store_of_their_own_process():
    assert pickle.loads(pickle.dumps(bpe.packed_words)) is bpe.packed_words


def test_word_store_of_token_files_is_bounded():
    encoder = token_files.WordEncoder(token_files.default_path())
    encoder.memo.limit = 50
    want = token_files.WordEncoder(token_files.default_path())
    for k in range(40):
        texts = [" ".join(f"w{(7 * k + i) % 90}x" for i in range(20)), "w1x w2x"]
        assert encoder.encode(texts) == want.encode(texts)
        assert len(encoder.memo) <= 50 and len(encoder.memo.old) <= 50


def test_sign_runs_of_latin_text_are_those_of_the_pattern():
    for a in token_files.LATIN:
        for b in token_files.LATIN:
            kinds = f"x{a}{b}x".encode("latin-1").translate(token_files.LOWER).translate(token_files.KINDS)
            assert any(r in kinds for r in token_files.SIGN_RUNS) == bool(token_files.SIGN_RUN.search(f"x{a}{b}x".lower()))
