"""Row types of the raw inputs and of the tables built from them."""

from __future__ import annotations

# --- raw inputs ------------------------------------------------------------

ENTRIES = """
    title string, url string, category string, last_update_source bigint, added double,
    meta map<string,string>,
    details struct<year:string, type:array<string>, status:string, origin:string>,
    additional_references map<string,string>,
    search_keywords array<string>, tags array<string>,
    content map<string, struct<text:array<string>, images:array<string>,
        subsections:map<string, struct<text:array<string>, images:array<string>>>>>,
    parent string, siblings array<string>, children array<string>, template_image_url string
"""

VISION_RECORD = """
    labelAnnotations array<struct<mid:string, description:string, score:double, topicality:double>>,
    safeSearchAnnotation struct<adult:string, medical:string, racy:string, spoof:string, violence:string>,
    webDetection struct<
        bestGuessLabels:array<struct<label:string, languageCode:string>>,
        fullMatchingImages:array<struct<url:string>>,
        partialMatchingImages:array<struct<url:string>>,
        visuallySimilarImages:array<struct<url:string>>,
        webEntities:array<struct<description:string, score:double>>>,
    error string
"""

ENTITY_RECORD = """
    `@text` string,
    Resources array<struct<`@surfaceForm`:string, `@similarityScore`:string, `@URI`:string>>,
    `@confidence` string, `@support` string, `@types` string, `@sparql` string, `@policy` string
"""

SCRAPE_LOG = """
    row_no int, url string, code int, views int, author string, updater string,
    added string, updated string, _corrupt_record string
"""

# --- list-free main table, as text columns of a delimited file ----------------

MAIN_TEXT_COLUMNS = [
    "id", "title", "url", "description", "views", "author", "updater", "added", "updated", "year",
    "has_relations", "has_other_texts", "has_refs", "has_DBpedia", "status", "adult", "medical", "racy",
    "spoof", "violence", "template_image_url", "fb_image_url",
]
MAIN_LIST_COLUMNS = [
    "alt_img_urls", "similar_images", "similar_images2", "image_recogn_labels", "image_recogn_scores",
    "search_keywords",
]
NUMBER_LISTS = ["image_recogn_scores", "scores"]
FLAGS = ["has_relations", "has_other_texts", "has_refs", "has_DBpedia"]

# --- relational model ------------------------------------------------------

ENTRY_TABLE = """
    meme_id string, title string, url string, description string, views int, author string,
    updater string, added timestamp_ntz, updated timestamp_ntz, year int, has_relations boolean,
    has_other_texts boolean, has_refs boolean, has_DBpedia boolean, status string, adult string,
    medical string, racy string, spoof string, violence string, template_image_url string,
    fb_image_url string, alt_img_urls string
"""
AUTHOR_TABLE = "author_id string, tot_views bigint"
UPDATER_TABLE = "updater_id string, tot_views bigint"

# Length limits of the relational model.
ENTRY_LIMITS = {
    "meme_id": 255, "title": 255, "url": 255, "description": 1000, "author": 255, "updater": 255,
    "status": 255, "adult": 255, "medical": 255, "racy": 255, "spoof": 255, "violence": 255,
    "template_image_url": 255, "fb_image_url": 255, "alt_img_urls": 255,
}
