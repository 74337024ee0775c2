"""Large shuffles of op13 are gone when the table that needed them is written."""

import random
import time

from gripelens.llm import edit_fingerprint as ef
from gripelens.runtime import shuffles_freed


def shuffle_bytes(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName(): files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left(spark, before):
    for _ in range(50):
        found = sum(n for name, n in shuffle_bytes(spark).items() if name not in before)
        if found < 100_000:
            break
        time.sleep(0.2)
    return found


def test_texts_do_not_stay_as_shuffle_files(spark):
    rnd = random.Random(3)
    rows = [(i, "".join(chr(rnd.randrange(33, 1000)) for _ in range(4000))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = shuffle_bytes(spark)
    beside = ef.beside_next(docs)
    assert left(spark, before) < 100_000  # the texts take more than a megabyte
    assert beside.count() == 200


def test_the_setting_is_restored(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
