import itertools
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions.edits import DELETION_MAX, allowed_edits
from marquee.functions.porter import stem_word
from marquee.functions.text import _WORD, analyze, ascii_fold, raw_keyword, strip
from marquee.operators.fuzzy import near_terms

# Word and stem pairs printed in the 1980 paper.
PAPER = """
caresses caress ponies poni caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc digitizer digit conformabli conform radicalli radic differentli differ
vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust
defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt
communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll
""".split()


def analysed(spark, texts, option):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", analyze(F.col("t"), option)).orderBy("i").collect()]


def test_stems_of_the_paper():
    assert [(w, stem_word(w)) for w in PAPER[::2]] == list(zip(PAPER[::2], PAPER[1::2]))


def test_tokenizer_rules(spark):
    texts = ["Dog's u.s.a a.1 1,000.5 x_y", "it’s 3.5, ok", "", "l'été, ½漢字 ab:c", "-- !!"]
    assert analysed(spark, texts, "standard") == [
        ["dog's", "u.s.a", "a", "1", "1,000.5", "x_y"],
        ["it's", "3.5", "ok"],
        [],
        ["l'ete", "漢", "字", "ab:c"],
        [],
    ]


def test_analyser_options(spark):
    texts = ["The Dogs' dog's running of CAFÉS", "Straße Œuvre"]
    assert analysed(spark, texts, "english_no_stem")[0] == ["dogs", "dog's", "running", "cafes"]
    assert analysed(spark, texts, "english_stem") == [["dog", "dog", "run", "cafe"], ["strass", "oeuvr"]]
    with pytest.raises(ValueError):
        analyze(F.lit("x"), "other")


def test_long_token_is_cut_and_never_overflows(spark):
    long = "a1" * 20_000
    tokens = analysed(spark, [f"{long} end"], "standard")[0]
    assert [len(t) for t in tokens[:2]] == [255, 255] and "".join(tokens[:-1]) == long and tokens[-1] == "end"


def test_strip_fold_raw(spark):
    row = spark.range(1).select(
        strip(F.lit(" \t x  \x1c")), ascii_fold(F.lit("Łódź ÆØ")), raw_keyword(F.lit("x" * 513)), raw_keyword(F.lit("x" * 512))
    ).first()
    assert (row[0], row[1], row[2], row[3]) == ("x", "Lodz AEO", None, "x" * 512)


def one_edit(word, alphabet):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in alphabet}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in alphabet}
        if i + 1 < len(word):
            out.add(word[:i] + word[i + 1] + word[i] + word[i + 2 :])
    return out - {word}


def test_near_terms_equal_brute_force(spark):
    rng = random.Random(7)
    alphabet = "abc"
    vocab = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(3000)}
    asked = {"".join(rng.choice(alphabet) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8)}
    long = "".join(rng.choice("abcdef") for _ in range(DELETION_MAX + 4))
    asked.add(long)
    for near in itertools.islice(one_edit(long, "az"), 60):
        vocab.add(near)
        vocab |= set(itertools.islice(one_edit(near, "b"), 20))
    frame = lambda words: spark.createDataFrame([(w,) for w in sorted(words)], "term string")
    got = {(r.query_term, r.term): r.edits for r in near_terms(frame(asked), frame(vocab)).collect()}
    want = {}
    letters = "abcdefz"
    for q in asked:
        reach = {q: 0}
        allowed = 0 if len(q) <= 2 else 1 if len(q) <= 5 else 2
        ring = {q}
        for step in range(1, allowed + 1):
            ring = set().union(*(one_edit(w, letters) for w in ring))
            for w in ring:
                reach.setdefault(w, step)
        want |= {(q, t): reach[t] for t in vocab if t in reach}
    assert got == want


def test_allowed_edits(spark):
    df = spark.createDataFrame([("ab",), ("abc",), ("abcde",), ("abcdef",)], "t string")
    assert [r[0] for r in df.select(allowed_edits(F.col("t"))).collect()] == [0, 1, 1, 2]


@given(st.text("abcdeiouystlz", min_size=1, max_size=12))
def test_stem_never_grows_much_and_is_prefix_like(word):
    stem = stem_word(word)
    assert stem and len(stem) <= len(word) + 1


def test_stem_memo_is_bounded():
    """Batches of ever new words: the memo stays below its bound, the stems stay right."""
    import pyarrow as pa

    from marquee.functions import text

    lists = [[[f"word{i}s" for i in range(at, at + 90_000)], None, ["x" * 200 + "s"]] for at in range(0, 360_000, 90_000)]
    stems = text.stem_tokens.func(pa.array(rows, pa.list_(pa.string())) for rows in lists)
    for rows, got in zip(lists, stems):
        assert got.to_pylist() == [[w[:-1] for w in rows[0]], None, ["x" * 200]]
        memo = stems.gi_frame.f_locals["memo"]
        assert len(memo) <= 200_000 and max(map(len, memo)) < 200


def test_words_follow_unicode_classes(spark):
    letter = r"[\p{L}\p{M}\p{Nl}&&[^\p{IsHan}\p{IsHiragana}]]"
    word = rf"[\p{{IsHan}}\p{{IsHiragana}}]|(?:{letter}++(?:[.:'’·]{letter}++)*+|\p{{Nd}}++(?:[.,;'’]\p{{Nd}}++)*+|_++)++"
    text = "".join(f"x{c} 1{c}a.b'1,2_{c}" for c in map(chr, range(0x20, 0x3200))) + "漢字ひ〇a"
    rows = spark.createDataFrame([(text,)], "text string")
    plain, own = rows.select(F.regexp_extract_all("text", F.lit(word), F.lit(0)), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).first()
    assert plain == own and len(own) > 20_000
