import pytest

from stratafold.llm.decontamination import leaks

ITEM = "春天的早晨，一位老人在河边慢慢地散步，看见远处的山上开满了花。答案是四十二。"


@pytest.mark.parametrize(
    "item, text",
    [
        (ITEM, f"他昨天对我们说过这样的话：{ITEM[:-1]}，后来大家都回家去了，再也没有提起。"),
        ("ฤดูใบไม้ผลิชายชราเดินเล่นริมแม่น้ำทุกเช้า", "เขาบอกว่าฤดูใบไม้ผลิชายชราเดินเล่นริมแม่น้ำทุกเช้าและกลับบ้าน"),
        ("say 'well known' words - or not - to old friends of ours", "they say “well known” words—or not—to old friends of ours…"),
        ("que hora es en la ciudad vieja ahora mismo", "«¿que hora es en la ciudad vieja ahora mismo?»"),
    ],
)
def test_copies_inside_other_text(spark, docs_of, item, text):
    others = ["今天天气很好我们去公园玩", "plain words of another kind stand here for a while"]
    docs = docs_of([(1, text)] + [(2 + i, others[i % 2]) for i in range(20)])
    rows = leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["in_order"]) for r in rows] == [(1, 1.0)]
