"""Sentence units of every language and layout."""

import pytest

from evidentia.llm.sentences import sentences

CASES = {
    "en": ["Gen. Vo and Dr. K. Te met at St. Quva pier at 5.03 a.m. on Monday.", "It was 6 p.m.", "“It is over.”", "“We saw 82 lights. Then nothing,” said Lt. Ne of the patrol.", '"Not now!" the captain shouted, and the line went dead.', "(The navy gave no reason.)", "The list is at www.ma.example/v12.0/log under No. 24.", "Ships, boats, etc. were counted, i.e. all of them.", "Nobody answered…", "The wind reached 9 m/s … and the search went on.", "Te Shipping Co. Ltd. denied it.", "Was it real?", "What a night!"],
    "fr": ["M. Se parle d'env. 45 ballons, dont 4,3 % de drones.", "« Tout est fini. »", "« Nous avons vu. Puis plus rien », raconte Mme Ne.", "Le no. 48 de la liste, p. ex. le Vu, reste à quai.", "Est-ce la fin ?"],
    "de": ["Am 3. Mai lagen ca. 70 Jets vor der Insel, z. B. die Ta.", "„Es ist vorbei.“", "„Wir sahen Lichter. Dann nichts“, sagte Dr. Pe.", "Nr. 5 gehört der Ta u. Co. KG.", "Später folgte mehr."],
    "es": ["¡Qué noche!", "El Sr. Fe habló de aprox. 29 buques.", "«Se acabó.»", "«Vimos luces. Luego nada», dijo la Dra. Ra.", "El núm. 52, p. ej. el Qu, sigue en puerto."],
    "ko": ['"끝났다."', '대변인은 "불빛을 봤다. 그 뒤로는 없었다."라고 말했다.', '"쏘지 마!"라고 선장이 외쳤고 교신은 끊겼다.', "(해군은 밝히지 않았다.)", "거리는 약 33.0해리다.", "응답이 없었다…"],
}
DENSE = {
    "zh": ["议员说：“我们看见了灯光。后来什么都没有。”随后便离开了雁翎礁。", "“别开火！”副部长喊道，通话随即中断。", "“结束了。”", "（边防警队没有说明原因。）", "距离约为26.2海里．", "无人应答……", "这真的是演习吗？", "没有人员受伤｡"],
    "ja": ["「終わった。」", "報道官は「光が見えました。そのあとは何も。」と語った。", "「撃つな！」と船長が叫び、通信は途絶えた。", "（内閣府は理由を明らかにしていない。）", "応答はなかった……", "本当に訓練だったのか？"],
}


def cut(spark, texts):
    df = spark.createDataFrame([(k, t, 3) for k, t in enumerate(texts)], "doc_id bigint, text string, pos int")
    out = {k: [] for k in range(len(texts))}
    for r in sorted(sentences(df).collect()):
        out[r.doc_id].append(texts[r.doc_id][r.sent_start: r.sent_end])
    return [out[k] for k in range(len(texts))]


def test_languages(spark):
    texts, want = [], []
    for parts in CASES.values():
        texts += [" ".join(parts), "\n\n".join(parts)]
        want += [parts, parts]
    for parts in DENSE.values():
        texts += ["".join(parts), "\n \n".join(parts)]
        want += [parts, parts]
    for t, got, w in zip(texts, cut(spark, texts), want):
        assert got == w, t


def test_layouts(spark):
    texts = ["Background\n\nThe ship left.It came\nback.\n\n- one: no change\n- two. Three\n\n(1) a\n(2) b", "LORNE, 3 May — The ship left. 😀 It came back", "สถานการณ์ ปกติ\n\nเรือ 3 ลำ"]
    assert cut(spark, texts)[:2] == [["Background", "The ship left.", "It came\nback.", "- one: no change", "- two. Three", "(1) a", "(2) b"], ["LORNE, 3 May — The ship left.", "😀 It came back"]]
    assert cut(spark, texts)[2][:2] == ["สถานการณ์", "ปกติ"]


@pytest.mark.parametrize("n", [1, 3000])
def test_long_texts_keep_their_offsets(spark, n):
    text = "The 😀 ship left at 5.30 a.m. today. " * n
    got = cut(spark, [text])[0]
    assert got == ["The 😀 ship left at 5.30 a.m. today."] * n


def test_cases(spark):
    assert cut(spark, ["", " \n　", "", "No stop"]) == [[], [], [""], ["No stop"]]
    df = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert sentences(df).count() == 0 and sentences(df.where("false")).count() == 0
