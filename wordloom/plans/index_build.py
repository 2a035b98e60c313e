"""The index build as a chain of stored tables.

Page text is scanned and split into words once. What later steps shuffle are word arrays per page, counts
per (document, word), and dictionary rows.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from wordloom.operators import dictionaries, postings, runs
from wordloom.operators.tokens import doc_tokens, page_tokens
from wordloom.plans.stages import Stage, side_by_side, stage, stage_dictionary, stage_firsts
from wordloom.sinks import tables, text
from wordloom.sources.runs import read_runs


@dataclass
class Index:
    """Stored tables of one build over pages (seq, file_no, url, doc), each made when first asked for.

    ``page_urls`` (seq, url) may come from a cheaper source than the pages, such as archive index files.
    """

    pages: DataFrame
    page_urls: DataFrame | None = None

    @property
    def url_map(self) -> DataFrame:
        return self._urls.table

    @property
    def lexicon(self) -> DataFrame:
        return self._words.table

    @cached_property
    def page_tokens(self) -> DataFrame:
        return stage(page_tokens(self.pages), "page_tokens").table

    @property
    def tokens(self) -> DataFrame:
        return doc_tokens(self.page_tokens, self.url_map, **self._urls.measured)

    @property
    def postings(self) -> DataFrame:
        self._make_dictionaries()
        return postings.postings(self.tokens, self.lexicon, **self._words.measured)

    @property
    def partial_postings(self) -> DataFrame:
        self._make_dictionaries()
        return postings.partial_postings(self.tokens, self.lexicon, **self._words.measured)

    def revisit_postings(self, by_file: bool = False) -> DataFrame:
        self._make_dictionaries()
        visits = postings.visits(self.tokens, self.lexicon, by_file, **self._words.measured)
        return postings.revisit_postings(stage(visits, "visits").table, by_file)

    def _make_dictionaries(self) -> None:
        """Neither dictionary needs the other."""
        side_by_side(self.pages.sparkSession, lambda: self._urls, lambda: self._words)

    @cached_property
    def _urls(self) -> Stage:
        page_urls = self.pages if self.page_urls is None else self.page_urls
        firsts = stage_firsts(dictionaries.url_firsts(page_urls), "url_firsts")
        return stage_dictionary(dictionaries.url_map(firsts.table, **firsts.measured), "url_map", "url")

    @cached_property
    def _words(self) -> Stage:
        firsts = stage_firsts(dictionaries.word_firsts(self.page_tokens), "word_firsts")
        return stage_dictionary(dictionaries.lexicon(firsts.table, **firsts.measured), "lexicon", "word")


def build_index(
    pages: DataFrame, out: str, page_urls: DataFrame | None = None, shard_docs: int = postings.SHARD_DOCS
) -> Index:
    """Write runs, postings, dictionaries and the indexes as text and bytes under ``out``.

    Postings are rolled up from the stored runs, so words are counted once. A word has a list, line or code
    for every ``shard_docs`` documents in which it is found.
    """
    spark = pages.sparkSession
    index = Index(pages, page_urls)
    tables.write_runs(index.partial_postings, f"{out}/runs")
    stored_runs = read_runs(spark, f"{out}/runs")
    text.write_lists_by_file(postings.partial_index_lines(stored_runs, shard_docs), f"{out}/partial_index")
    tables.write_postings(runs.roll_up(stored_runs), f"{out}/postings")
    stored = spark.read.parquet(f"{out}/postings")
    text.write_lines(text.lexicon_lines_by_id(index.lexicon), f"{out}/lexicon_by_id", "word_id")
    text.write_lines(text.url_map_lines(index.url_map), f"{out}/url_map_by_id", "doc_id")
    text.write_lists(postings.global_index_lines(stored, shard_docs), f"{out}/global_index")
    tables.write_lists(postings.posting_bytes(stored, shard_docs), f"{out}/posting_bytes")
    return index
