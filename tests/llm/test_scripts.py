"""Texts in scripts without spaces, other alphabets, and program code."""

import random

import numpy as np
import pytest
from samples import documents, prose
from pyspark.sql import functions as F

from signalframe.llm import decontaminate, langid, quality, recipes

SENTENCES = {
    "zh": ["今天的天气非常好，我们一起去公园散步。", "这本书讲述了一个古老城市的历史。", "科学家发现了新的行星，引起了广泛关注。", "他说：「明天会下雨吗？」",
           "学生们在图书馆里安静地读书。", "经济增长速度比去年有所放缓。", "医生建议病人多喝水，多休息。", "火车晚点了二十分钟才到达车站。"],
    "ja": ["今日は天気がとても良いので、公園を散歩しました。", "この本は古い町の歴史について書かれています。", "科学者たちは新しい惑星を発見しました。",
           "電車が二十分遅れて駅に着きました。", "学生は図書館で静かに本を読んでいます。", "彼女は毎朝コーヒーを飲みます。"],
    "th": ["วันนี้อากาศดีมากเราจึงไปเดินเล่นในสวน", "หนังสือเล่มนี้เล่าประวัติศาสตร์ของเมืองเก่า", "นักวิทยาศาสตร์ค้นพบดาวเคราะห์ดวงใหม่",
           "รถไฟมาถึงสถานีช้ากว่ากำหนดยี่สิบนาที", "นักเรียนอ่านหนังสือเงียบๆในห้องสมุด", "แพทย์แนะนำให้ผู้ป่วยดื่มน้ำมากขึ้น"],
    "ar": ["كان الطقس جميلا اليوم فذهبنا إلى الحديقة.", "يتحدث هذا الكتاب عن تاريخ المدينة القديمة.", "اكتشف العلماء كوكبا جديدا، فهل توجد فيه حياة؟",
           "وصل القطار إلى المحطة متأخرا عشرين دقيقة.", "يقرأ الطلاب الكتب في المكتبة بهدوء."],
    "el": ["Ο καιρός ήταν πολύ καλός σήμερα και πήγαμε στο πάρκο.", "Το βιβλίο αυτό μιλάει για την ιστορία της παλιάς πόλης.",
           "Οι επιστήμονες ανακάλυψαν έναν νέο πλανήτη.", "Το τρένο έφτασε στον σταθμό με καθυστέρηση."],
}
CODE = [
    "def add(a, b):\n    total = a + b\n    return total\n", "for (int i = 0; i < n; i++) {\n    sum += values[i];\n}\nreturn sum;",
    "import os\n\nclass Store:\n    def __init__(self, path):\n        self.path = path\n\n    def names(self):\n        return os.listdir(self.path)\n",
    "fn main() {\n    let x = vec![1, 2, 3];\n    println!(\"{}\", x.len());\n}", "const f = (x) => x * 2;\nconsole.log(f(21));",
    "#include <stdio.h>\nint main(void) {\n    printf(\"hi\\n\");\n    return 0;\n}", "items = [x ** 2 for x in range(10)]\nprint(sum(items))",
]
JUNK = ["## $$ %% || <<>> {{ @@ ^^ ~~ ** 12 && __ ==", "BUY NOW!!! CHEAP!!! CLICK HERE!!! BEST PRICE!!! NOW!!!", "a | b | c | 1 | 2 | 3 | x | y |", "spam spam spam spam spam spam spam spam spam spam"]


def written(language: str, seed: int) -> str:
    draw = random.Random(seed)
    return (" " if language in ("ar", "el") else "").join(draw.choice(SENTENCES[language]) for _ in range(draw.randrange(4, 12)))


def ideographs(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(n))


def test_quality_keeps_every_script_and_programs(spark):
    texts = [prose(60 + k % 50, k) for k in range(200)] + [written(x, k) for x in SENTENCES for k in range(20)] + CODE
    good = len(texts)
    texts += [f"{JUNK[k % 4]} {JUNK[k % 4]} {k}" for k in range(60)]
    scored = quality.scored(documents(spark, texts)).select("doc_id", quality.SCORE).collect()
    rejected = sorted(r.doc_id for r in scored if r[quality.SCORE] < 0.5)
    assert rejected == list(range(good, len(texts)))


@pytest.mark.parametrize("text", [*JUNK, "(see) the {odd} words [here] and there\nplain words in a row\nmore words", "", "()", "#%& ({ $$ *|"])
def test_junk_and_prose_are_no_programs(text):
    assert not quality.is_code(text)


@pytest.mark.parametrize("text", CODE)
def test_programs(text):
    assert quality.is_code(text) and quality.votes(text)[:3] == "---"


def test_units():
    assert quality.units("他说：「好。」 ok then") == ["他", "说：", "「好。」", "ok", "then"]
    assert all(map(quality.is_plain, quality.units(written("th", 1) + written("zh", 1)))) and not quality.is_plain("「」")


@pytest.mark.parametrize("language", ["zh", "ja", "th"])
def test_passages_inside_unspaced_text_are_found(spark, language):
    item = written(language, 101)
    edited = item[:9] + "龘" + item[10:20] + item[21:]
    texts = [f"前言「{item}」後記", f"{written(language, 3)[:30]}{edited}", ideographs(300, 4), item[: len(item) // 3], f"Latin words, then “{item}” again"]
    benchmark = spark.createDataFrame([(1, item), (2, "龍龍龍")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(documents(spark, texts), benchmark).collect()}
    assert found == {(0, 1): 0, (1, 1): 2, (4, 1): 0}


def test_words_of_unspaced_and_spaced_text():
    hashes = decontaminate.word_hashes
    assert len(hashes("今天ok好，ไทย")) == 7 and len(hashes("slow “quick” fox")) == 3
    assert list(hashes("“Quick”，fox")) == list(hashes("quick fox"))


def test_bitmaps_grow_with_their_entries(spark, monkeypatch):
    few = decontaminate.bitmap_of(spark.range(10), "id")
    assert len(few) == 1 << (decontaminate.SMALLEST - 6) and decontaminate.bit_of(np.arange(20, dtype=np.uint64), few).sum() == 10
    monkeypatch.setattr(decontaminate, "SMALLEST", 8)
    many = decontaminate.bitmap_of(spark.range(1000), "id")
    assert len(many) * 64 >= decontaminate.BITS * 1000 / 2


@pytest.mark.parametrize("alphabet", [
    [chr(c) for c in range(0x4E00, 0x9FA5)], [chr(c) for c in range(0x0E01, 0x0E2F)], [chr(c) for c in range(0x3041, 0x3094)],
    [chr(c) for c in range(0xAC00, 0xD7A3)], list("0123456789abcdef"), [*map(chr, range(65, 91)), *map(chr, range(97, 123)), *"0123456789+/"], list("0123456789"),
])
def test_chunks_are_shared_after_an_insertion(spark, alphabet):
    draw = random.Random(7)
    text = "".join(draw.choices(alphabet, k=40_000))
    chunked = recipes.document_chunks(documents(spark, [text, "x" + text])).select("doc_id", F.explode("chunks").alias("c"))
    first, second = ({r.c for r in chunked.where(f"doc_id = {k}").collect()} for k in (0, 1))
    assert len(first & second) >= 0.7 * len(first) and len(first) >= 8


def test_numerals_are_no_letters(spark):
    texts = [prose(80, k) for k in range(20)]
    rows = spark.createDataFrame([(k, t, "aa" if k % 2 else "bb") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.fit(rows)
    assert all(model.predict(t) == ("und", 0.0) for t in ("½ ²", "Ⅷ", "12 ½", "_"))
    assert langid.words_of("Ⅷbaⅷdo² ba") == {"ba": 2, "do": 1} and model.predict("balen²")[0] != "und"
