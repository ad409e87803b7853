"""Declared schemas of stored tables."""

OCR_PAGES = "item_id string, page int, rec_texts array<string>, rec_scores array<double>, rec_boxes array<array<int>>"
LAYOUT_BLOCKS = "item_id string, page int, block_idx int, label string, content string, confidence double, x1 int, y1 int, x2 int, y2 int"
METADATA = (
    "struct<item_id:string,page:int,type:string,section_titles:array<string>,primary_section:string,context_hierarchy:string,"
    "bbox:array<int>,ocr_confidence:double,elements_count:int,token_count:int,hierarchy_levels:array<int>>"
)
CHUNKS = f"fragment_id string, content string, metadata {METADATA}"
INDEX = f"{CHUNKS}, embeddings array<float>"
REQUESTS = "item_id string, page_range struct<start:int,end:int>"
