import __spark_entry__ as entry


def test_entry_and_queries_run(spark, sf):
    assert entry.entry(spark).count() > 0
    own = entry.queries()
    assert set(entry.oracle_sql()) <= set(own)
    for name in ("url_allow_deny", "v_summary", "report_lines", "preview_pages", "sitemap_walk", "merge_volume_sizes"):
        assert own[name](spark, sf).columns
