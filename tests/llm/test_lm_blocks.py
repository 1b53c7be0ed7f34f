"""Blocks of the language model are bounded whatever files and frames hold the texts."""

from pyspark.sql import functions as F

from ledgerlake.llm import lm

LIMIT = 4000


def sizes(rows):
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + lm.ROW_BYTES
    return [row.n for row in lm.in_blocks(rows, LIMIT).groupBy("block").agg(F.sum(weight).alias("n")).collect()]


def test_blocks_of_one_file_of_equal_texts_and_of_shuffled_frames(spark, tmp_path):
    rows = spark.range(900, numPartitions=1).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "equal words of many texts").when(F.col("id") % 5 > 0, F.repeat(F.lit("w "), 40)).alias("text"),
        (F.col("id") % 7 == 0).alias("held_out"))
    rows.write.parquet(str(tmp_path / "one"))
    file = spark.read.parquet(str(tmp_path / "one"))
    longest = 80 + lm.ROW_BYTES
    total = sum(sizes(file))
    for frame in (file, file.repartition(2), file.dropDuplicates(["doc_id", "text"]), rows):
        found = sizes(frame)
        assert max(found) < LIMIT + longest
        assert len(found) >= sum(found) // (LIMIT + longest)
    assert total == sum(sizes(rows)) and total > 10 * LIMIT


def test_scores_do_not_depend_on_the_blocks(spark, tmp_path):
    spark.range(300, numPartitions=1).select("id", F.concat_ws(" ", F.sequence(F.col("id") % 7, F.col("id") % 11)).alias("text")).write.parquet(
        str(tmp_path / "one"))
    docs = spark.read.parquet(str(tmp_path / "one"))
    few, many = ({row.doc_id: row for row in lm.score(docs, "id", "text", F.col("id") % 5 == 1, limit).collect()}
                 for limit in (lm.BLOCK_BYTES, 500))
    assert len(few) == len(many) == 300
    for key, row in few.items():
        assert row[1:5] == many[key][1:5]
        assert abs(row.base_score - many[key].base_score) < 1e-9 and abs(row.score - many[key].score) < 1e-4
