"""Landed runs for the tests, generated from the contract's field lists.

Every leaf gets a value of its own, made from its name and a seed; a test states the values it is about.
"""

import json
import random
import zlib
from pathlib import Path

from pyspark.sql import types as T

from pagetide.schemas import PAGE_REPORT, PAYLOAD, REVIEW_JSON, SAFE_AUTHOR_FIELDS

SHOP, CLOSED = "4210", "8800"

# The author fields of the contract that are personal and must never be stored.
PERSONAL = ["steamid", "personaname", "profile_url", "avatar", "persona_status"]
PRIVATE = {name: f"private-{name}-{zlib.crc32(name.encode()):x}" for name in PERSONAL}

FLAGS = {"voted_up", "steam_purchase", "received_for_free", "written_during_early_access", "primarily_steam_deck"}
WORDS = {"language", "review", "recommendationid", "cursor", "review_score_desc"}


def leaf(name, seed):
    rng = random.Random(f"{name}/{seed}")
    if name in FLAGS:
        return rng.random() < 0.5
    if name in WORDS:
        return f"{name.replace('_', ' ')} {rng.randrange(10**6)}"
    return f"0.{rng.randrange(100, 999)}" if name.startswith("weighted") else rng.randrange(1, 5000)


def filled(schema, seed):
    """A document of the schema: structs as objects, arrays empty."""
    values = {}
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            values[field.name] = filled(field.dataType, seed)
        else:
            values[field.name] = [] if isinstance(field.dataType, T.ArrayType) else leaf(field.name, seed)
    return values


def review(key="r-1", text="A long wait, but the soup was good.", updated=1, seed=0, **changes):
    row = filled(REVIEW_JSON, seed)
    assert set(row["author"]) == set(SAFE_AUTHOR_FIELDS)
    row["author"] |= PRIVATE
    return row | {"recommendationid": key, "review": text, "timestamp_updated": updated} | changes


def payload(reviews, cursor="more", success=1, seed=0, **summary):
    document = filled(PAYLOAD, seed) | {"success": success, "cursor": cursor, "reviews": reviews}
    document["query_summary"] |= {"num_reviews": len(reviews)} | summary
    return document


def report(run_id, app_id=SHOP, page_number=1, **changes):
    row = {field.name: None if isinstance(field.dataType, T.StringType) else 0 for field in PAGE_REPORT}
    row |= {"run_id": run_id, "app_id": app_id, "app_name": f"Shop {app_id}", "page_number": page_number, "attempt_count": 1}
    row |= {"status": "fetched", "status_code": 200, "cursor": "start", "next_cursor": "", "terminal_reason": "missing_next_cursor"}
    row |= {"raw_json_path": f"/other/place/{page_name(app_id, page_number)}", "review_count": 1, "fetched_at": "2031-02-03T04:05:06+00:00"}
    return row | {"max_timestamp_updated": 1, "min_timestamp_updated": 1} | changes


def page_name(app_id, page_number):
    return f"app_{app_id}_page_{page_number:04d}.json"


def land(root: Path, run_id: str, pages) -> str:
    """`pages` is a list of (report, reviews or None); an indented document per page, a blank line between reports."""
    folder = root / "raw" / run_id
    folder.mkdir(parents=True, exist_ok=True)
    for row, reviews in pages:
        if reviews is not None:
            (folder / page_name(row["app_id"], row["page_number"])).write_text(json.dumps(payload(reviews), indent=1), encoding="utf-8")
    reports = "\n\n".join(json.dumps(row, ensure_ascii=False) for row, _ in pages)
    (folder / "review_pages.jsonl").write_text(f"{reports}\n", encoding="utf-8")
    return str(folder)


def write_targets(root: Path) -> str:
    path = root / "targets.csv"
    lines = ["app_id,app_name,active,notes", f"{SHOP},Corner Shop,true,first", f"{CLOSED},Closed Shop,false,"]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
