"""Crawl analytics as Spark jobs over tables and streams of captured pages.

Column functions (``crawlstats.functions``) are pure ``Column -> Column``
builders; operators (``crawlstats.operators``) take and return DataFrames;
sources/sinks read and write tables; ``crawlstats.streaming`` holds the
Structured Streaming versions of the reports; ``crawlstats.plans`` registers
the queries checked against DuckDB.
"""

from crawlstats.config import CrawlParams, TEST_PARAMS, shared_dir

__all__ = ["CrawlParams", "TEST_PARAMS", "shared_dir"]
