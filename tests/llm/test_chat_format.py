import hashlib

from rewardflow.llm.chat_format import INSTRUCT, chat_digest, format_conversations, read_back

ROWS = "conv_id long, turn long, role string, text string, formatted string, turns string, segments long"


def make(spark, rows):
    return spark.createDataFrame([(*r, "f", "t", 1) for r in rows], ROWS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_hostile_texts(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\-", "\\\\-x", "<<SYS>>\n<</SYS>>", "<s", "s>", "<\\-s>", "[[INST]]", "",
             "[ROLE]x[TEXT]y[/TEXT]", "é日本 $1 \\$1", "<<s></s>", "a\r\nb\x00"]
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", text) for i in range(3) for t, text in enumerate(texts)]
    rows += [(7, 0, None, "<s>"), (7, 1, "tool<s>", "x"), (7, 2, "", None), (7, None, "user", "late"), (7, 2, "", None)]
    out = {r.conv_id: r for r in read_back(format_conversations(make(spark, rows))).collect()}
    for i in range(3):
        assert [(t.role, t.text) for t in out[i].turns] == [(r[2], r[3]) for r in rows if r[0] == i]
        assert out[i].loss_text == "".join(texts[1::2])
        assert out[i].formatted == "".join(s.text for s in out[i].segments)
        assert out[i].valid
    assert [(t.role, t.text) for t in out[7].turns] == [("", "<s>"), ("tool<s>", "x"), ("", ""), ("", ""), ("user", "late")]
    assert not out[7].valid
    for r in out.values():
        for s in r.segments:
            assert s.text in INSTRUCT.controls or not any(c in s.text for c in INSTRUCT.controls)


def test_role_machine(spark):
    def turns(i, roles):
        return [(i, k, r, "x") for k, r in enumerate(roles.split())]
    rows = (turns(1, "system user assistant") + turns(2, "user assistant user") + turns(3, "assistant user")
            + turns(4, "user user assistant") + turns(5, "user assistant system assistant") + turns(6, "user assistant"))
    got = {r.conv_id: r.valid for r in format_conversations(make(spark, rows)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}


def test_digest_null_ids_and_long_texts(spark):
    long = "é\\<s>" * 100_000
    rows = [(None, 0, "user", long), (None, 1, "assistant", long), (2, 0, "user", None)]
    out = {r.conv_id: r for r in chat_digest(make(spark, rows)).collect()}
    assert out[None].turns_sha256 == sha(f"user\n{long}\nassistant\n{long}\n")
    assert out[None].loss_chars == len(long) and out[None].loss_sha256 == sha(long)
    assert out[2].loss_sha256 == sha("") and out[2].n_turns == 1


def test_empty_table(spark):
    assert chat_digest(make(spark, [])).count() == 0
