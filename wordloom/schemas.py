"""Fixed schemas of every table the engine reads or writes."""

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _LONG, _STR, _BIN = T.IntegerType(), T.LongType(), T.StringType(), T.BinaryType()

PAGE_INDEX = _table(file_no=_LONG, line_no=_LONG, url=_BIN, length=_LONG)
RAW_PAGES = _table(file_no=_LONG, line_no=_LONG, url=_BIN, start_at=_LONG, length=_LONG, doc=_BIN)
SCANNED_PAGES = _table(file_no=_LONG, line_no=_LONG, url=_BIN, start_at=_LONG, length=_LONG, doc=_BIN, reason=_STR)
PAGES = _table(seq=_LONG, file_no=_LONG, url=_STR, doc=_STR)
URL_MAP = _table(url=_STR, doc_id=_LONG)
LEXICON = _table(word=_STR, word_id=_LONG)
POSTINGS = _table(word_id=_LONG, doc_id=_LONG, tf=_LONG)
RUNS = _table(file_no=_LONG, word_id=_LONG, doc_id=_LONG, tf=_LONG)
TRIPLES = _table(word_id=_INT, doc_id=_INT, tf=_INT)
WORD_STATS = _table(word_id=_LONG, df=_LONG, tf_sum=_LONG, max_doc_id=_LONG)
FILTERS = _table(batch=_LONG, bucket=_INT, n=_LONG, max_id=_LONG, bits=T.ArrayType(_LONG))
