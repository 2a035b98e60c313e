"""Text outputs, as folders of part files whose names follow the order of the lines."""

from pyspark.sql import DataFrame

from wordloom.functions.lines import dictionary_line


def url_map_lines(url_map: DataFrame) -> DataFrame:
    """(doc_id, url, line) with line '3 host/path'."""
    return url_map.select("doc_id", "url", dictionary_line("doc_id", "url").alias("line"))


def lexicon_lines_by_id(lexicon: DataFrame) -> DataFrame:
    """(word_id, word, line) with line '3 word'."""
    return lexicon.select("word_id", "word", dictionary_line("word_id", "word").alias("line"))


def lexicon_lines_by_word(lexicon: DataFrame) -> DataFrame:
    """(word_id, word, line) with line 'word 3'."""
    return lexicon.select("word_id", "word", dictionary_line("word", "word_id").alias("line"))


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """Write column ``line`` sorted by ``order``."""
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("line").write.mode("overwrite").text(path)


def write_lists(lines: DataFrame, path: str) -> None:
    """Write global index lines, one folder per shard; they are in ranges of shards and words already."""
    ordered = lines.sortWithinPartitions("shard", "word_id")
    ordered.select("shard", "line").write.mode("overwrite").partitionBy("shard").text(path)


def write_lists_by_file(lines: DataFrame, path: str) -> None:
    """Write partial index lines, one folder per input file, each sorted by word; they are in such ranges already."""
    ordered = lines.sortWithinPartitions("file_no", "word_id", "shard")
    ordered.select("file_no", "line").write.mode("overwrite").partitionBy("file_no").text(path)
