"""The pipeline's language rejection: clean mixed-script texts stay, unlearned languages go."""

import random

from llm_data import DOCS, SYLLABLES, prose

from skewkit.llm import langid

FOREIGN = "漢字仮名交じり文本引用標題東京大阪京都北海道沖縄春夏秋冬花鳥風月山川草木日月星辰天地"
EMOJI = "".join(chr(0x1F600 + i) for i in range(20))
UNLEARNED = "zba kwo gdy prz szc mło jak nik wzg ryb".split()


def test_mixed_scripts_stay_and_unlearned_languages_go(spark):
    rng = random.Random(8)
    learned = [(i, prose(rng, lang, rng.randint(40, 80)), lang, "s", 0) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    clean = [prose(rng, "en", 60) + " " + extra + " " + prose(rng, "en", 15) for extra in (FOREIGN, EMOJI) for _ in range(5)]
    clean += [prose(rng, "de", 70) + "\n" + FOREIGN[:30], "the thing with another"]
    other = [" ".join("".join(rng.choices(UNLEARNED, k=rng.randint(1, 3))) for _ in range(70)) for _ in range(8)]
    data = learned + [(1000 + i, t, None, None, None) for i, t in enumerate(clean)] + [(2000 + i, t, None, None, None) for i, t in enumerate(other)]
    kept = {r["doc_id"] for r in langid.accepted_documents(spark.createDataFrame(data, DOCS)).collect()}
    assert {i for i in kept if 1000 <= i < 2000} == set(range(1000, 1000 + len(clean)))
    assert not {i for i in kept if i >= 2000}
    assert len([i for i in kept if i < 1000]) >= 297


def test_no_held_out_rows_no_bound(spark):
    data = [(0, prose(random.Random(1)), "en", "s", 0), (2, "zzz qqq " * 30, None, None, None)]
    assert langid.accepted_documents(spark.createDataFrame(data, DOCS)).count() == 2
    assert langid.accepted_documents(spark.createDataFrame([], DOCS)).count() == 0
