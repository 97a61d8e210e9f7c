"""Print the SURVEY section 2 coverage map (inventory id -> queries / functions)
as a markdown table; used to write COVERAGE.md."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressroom.plans.registry import load_all  # noqa: E402

SECTIONS = {"A": 14, "B": 14, "C": 20, "E": 7, "F": 4, "G": 6, "H": 5, "I": 22, "J": 8, "K": 6,
            "L": 3, "M": 4}
JOINS = [f"D{i}j" for i in range(1, 8)]

# Items served by library functions (not, or not only, by a registered query).
NOTES = {
    "A1": "`sources/tables.read_table`; JDBC form `sources/staging.read_jdbc` (untested: needs a database)",
    "A2": "`sources/staging.write_csv`",
    "A5": "`operators/sequence.append_ids`",
    "A6": "`sources/staging.publish_version` (upsert written as a new bucketed version)",
    "A8": "`sources/staging.export_csv(accumulate=False)`",
    "A9": "`operators/extract.rss_items` (payload column); files: `sources/lists.read_rss_files`",
    "A12": "`sources/lists.read_ranked_list`; join `operators/score.authority_rank`",
    "A13": "`functions/themes` (fixed list) and `sources/lists.read_keyword_list` / `keyword_string`",
    "B10": "`operators/extract.pager_size` (in `page_meta`)",
    "B12": "rules table of `operators/ingest.RULES`; `plans/bindings.source_rules`",
    "C19": "`operators/ingest.ingest_run`: quarantine of sources without rows, and of broken payloads",
    "B8": "`operators/markup`: drop lists with steps by class, attribute, text and ancestor",
    "C15": "`sources/layout.write_zordered` (Bloom filters)",
    "C17": "`operators/select.text_search` (scan), `operators/search` (trigram index)",
    "G5": "`sources/layout.write_feed` / `feed_page`",
    "H4": "`operators/evolve.dedupe_exact`, `operators/similar.dedupe_near`",
    "L1": "`streaming/incremental`: `upsert_ingest`, `crawl_ingest`",
    "L2": "`streaming/incremental.dedupe_ingest` (keyed state)",
    "A10": "`operators/extract.json_hits` / `json_fragments` (items[].html, rendered, html)",
    "B5": "`operators/markup.extract_container` (container, drop list, way of taking the text)",
    "B9": "`operators/markup.meta_content`",
    "K1": "`operators/ingest.ingest_job(feeds, listings, pages, stored, run_log, rules, as_of)`",
    "E1": "`operators/ingest.last_success`",
    "C6": "predicate pushdown (built in); asserted in `tests/test_properties.py`",
    "G3": "`orderBy(id)` in prompt_search / email_search",
    "I4": "`functions/text.strip` (btrim over the Unicode separator set)",
    "I5": "`functions/text.is_blank`",
    "I8": "`functions/dates.parse_date('iso_prefix')`",
    "I18": "`functions/dates.format_ntz` (time-zone free)",
    "I20": "`operators/select.derive_flags`, `operators/evolve.backfill_nulls`",
    "J3": "`operators/enrich.GenerateStub` through `enrich`",
    "J6": "`enrich(rate_per_sec=...)` token bucket; `tests/test_sources.py::test_throttle_spaces_calls`",
    "J7": "`model` parameter of the stub clients",
    "M4": "no-op in a typed schema (string has no length; default in `schemas.NEWS_DEFAULTS`)",
    "F3": "`authority_rank` (min rank per name)",
    "K2": "`plans/q_enrich.translate_summarize_job(news, translator, summarizer, ...)`",
    "K3": "`plans/q_enrich.vectorize_request_job(news, replies, embedder, classifier, ...)`",
    "K4": "`operators/score.score_news(work, replies, authority, as_of)`",
    "D6j": "`operators/relate.upsert`; bucketed forms `sources/staging.publish_version`, `sources/layout.merge_buckets`",
}


def main() -> None:
    reg = load_all()
    by_id: dict[str, list[str]] = {}
    for name, q in reg.items():
        for tok in re.findall(r"\b([A-M][0-9]+j?)\b", q.ids):
            by_id.setdefault(tok, []).append(name)
    ids = [f"{s}{i}" for s, n in SECTIONS.items() for i in range(1, n + 1)]
    ids = ids[: ids.index("C20") + 1] + JOINS + ids[ids.index("C20") + 1:]
    print("| SURVEY id | queries (oracle-checked) | library / notes |\n|---|---|---|")
    missing = []
    for i in ids:
        qs = ", ".join(sorted(by_id.get(i, [])))
        note = NOTES.get(i, "")
        if not qs and not note:
            missing.append(i)
        print(f"| {i} | {qs} | {note} |")
    print(f"\nNot covered: {', '.join(missing) if missing else 'none'}")


if __name__ == "__main__":
    main()
