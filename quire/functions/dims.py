"""Small dimension tables, as plain values and as DataFrames. All have a fixed number of rows, so joins may broadcast them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LABELS = ("Arabic", "English", "Indonesia")
LANGS = {"ar": "Arabic", "en": "English", "id": "Indonesia"}
TOTAL_PAGES = 604

# Chapter starts and slugs.
CHAPTERS = (
    (1, 11, "chapter_01_letters"), (2, 16, "chapter_02_breaking_expansion_times"), (3, 26, "chapter_03_lunar_mansions"),
    (4, 32, "chapter_04_zodiac_signs"), (5, 38, "chapter_05_basmala_secrets"), (6, 54, "chapter_06_seclusion_retreat"),
    (7, 56, "chapter_07_jesus_names"), (8, 62, "chapter_08_four_tawqifat"), (9, 67, "chapter_09_quran_beginnings"),
    (10, 75, "chapter_10_fatiha_secrets"), (11, 84, "chapter_11_inventions_lights"), (12, 92, "chapter_12_greatest_name"),
    (13, 108, "chapter_13_fatiha_omissions"), (14, 113, "chapter_14_spiritual_exercises"),
    (15, 148, "chapter_15_conditions_beginnings_endings"), (16, 165, "chapter_16_beautiful_names"),
    (17, 207, "chapter_17_kaf_ha_ya_ayn_sad"), (18, 224, "chapter_18_verse_of_throne"),
    (19, 241, "chapter_19_wafqs_talismans"), (20, 260, "chapter_20_yaseen"), (21, 268, "chapter_21_names_pattern_one"),
    (22, 281, "chapter_22_names_pattern_two"), (23, 285, "chapter_23_names_pattern_three"),
    (24, 288, "chapter_24_names_pattern_four"), (25, 294, "chapter_25_names_pattern_five"),
    (26, 297, "chapter_26_names_pattern_six"), (27, 299, "chapter_27_names_pattern_seven"),
    (28, 303, "chapter_28_names_pattern_eight"), (29, 305, "chapter_29_names_pattern_nine"),
    (30, 308, "chapter_30_names_pattern_ten"), (31, 310, "chapter_31_arabic_letters"), (32, 320, "chapter_32_arod_secrets"),
    (33, 340, "chapter_33_circle_encompassment"), (34, 351, "chapter_34_zayirja_science"), (35, 365, "chapter_35_jafr_rules"),
    (36, 379, "chapter_36_talismanic_letters"), (37, 398, "chapter_37_simia_works"),
    (38, 401, "chapter_38_letter_uses_retreats"), (39, 423, "chapter_39_beautiful_names_explanation"),
    (40, 516, "chapter_40_answered_supplications"),
)
# First pages of the thirty sections.
SECTIONS = (
    (1, 1), (2, 22), (3, 43), (4, 64), (5, 85), (6, 106), (7, 127), (8, 148), (9, 169), (10, 190),
    (11, 211), (12, 232), (13, 253), (14, 274), (15, 295), (16, 316), (17, 337), (18, 358), (19, 379), (20, 400),
    (21, 421), (22, 442), (23, 463), (24, 484), (25, 505), (26, 526), (27, 547), (28, 568), (29, 589), (30, 598),
)
# First pages of the parts of the printed edition.
PARTS = (
    ("I", 1), ("II", 10), ("III", 11), ("IV", 17), ("V", 24), ("VI", 32), ("VII", 40), ("VIII", 53), ("IX", 61), ("X", 68),
    ("XI", 93), ("XII", 108), ("XIII", 113),
)

# The figures of the printed edition by number, with their page, the block that they stand behind (-1: before all) and their size.
FIGURES = (
    (1, 2, 99, "md"), (2, 4, 99, "md"), (3, 6, 99, "plate"), (4, 7, -1, "plate"), (5, 8, -1, "lg"), (6, 12, 99, "lg"), (7, 14, 2, "md"), (8, 15, 1, "md"), (9, 16, 2, "md"), (10, 17, 2, "lg"),
    (11, 18, 1, "lg"), (12, 19, 1, "md"), (13, 21, 6, "md"), (14, 23, 6, "sm"), (15, 24, 7, "lg"), (16, 25, 1, "lg"), (17, 25, 99, "plate"), (18, 26, 99, "plate"), (19, 27, 99, "plate"), (20, 28, 99, "plate"),
    (21, 29, 99, "plate"), (22, 30, 99, "plate"), (23, 31, 9, "plate"), (24, 33, 1, "lg"), (25, 41, 27, "lg"), (26, 45, 12, "sm"), (27, 47, 0, "md"), (28, 53, 1, "lg"), (29, 56, 4, "md"), (30, 57, 8, "sm"),
    (31, 60, 1, "md"), (32, 61, 7, "md"), (33, 64, 0, "lg"), (34, 64, 2, "tall"), (35, 67, 3, "sm"), (36, 78, 1, "md"), (37, 80, 1, "sm"), (38, 82, 2, "md"), (39, 84, 1, "lg"), (40, 95, 0, "fullplate"),
    (41, 97, 1, "lg"), (42, 97, 2, "lg"), (43, 99, 2, "lg"), (44, 99, 2, "md"), (45, 100, 2, "lg"), (46, 100, 4, "lg"), (47, 102, 1, "lg"), (48, 104, 3, "md"), (49, 105, 0, "md"), (50, 105, 0, "md"),
    (51, 112, 1, "fullplate"), (52, 113, 2, "lg"), (53, 121, -1, "lg"),
)

# Titles of the last pages, pages whose rest is classified, and the cells of two grid pages by language.
TAIL_TITLES = {
    601: {"ar": "صفحة فارغة", "en": "Blank Page", "id": "Halaman Kosong"},
    602: {"ar": "بطاقة إعارة المكتبة", "en": "Library Due-Date Card", "id": "Kartu Tempo Peminjaman Pustaka"},
    603: {"ar": "صفحة فارغة", "en": "Blank Page", "id": "Halaman Kosong"},
    604: {"ar": "صفحة فارغة", "en": "Blank Page", "id": "Halaman Kosong"},
}
CANDIDATES = (
    ("en", 84), ("id", 84), ("en", 95), ("id", 95), ("en", 105), ("id", 105), ("id", 117), ("id", 134), ("id", 250), ("en", 331),
    ("en", 332), ("en", 402), ("id", 402), ("id", 550), ("id", 587), ("id", 600), ("id", 601), ("en", 603), ("id", 603), ("en", 604),
)
CELLS = {105: ("[في المربع]", {"en": "[in the square]", "id": "[Di dalam persegi]"}), 253: ("[?]", {"en": "[?]", "id": "[?]"})}

# Exact markers of pages without text, and builders' fallbacks, which are never translations.
BLANK_MARKERS = {"en": "[NO VISIBLE TEXT]", "id": "[TIDAK ADA TEKS TERLIHAT]"}
FALLBACKS = {
    "parser": {
        "en": (
            "(no english text on this page)", "(no english text on this page.)", "(no arabic text on this page)",
            "there is no text on this page.", "there is no visible arabic text on this page.",
        ),
        "id": (
            "(tidak ada teks pada halaman ini)", "(tidak ada teks pada halaman ini.)", "tidak ada teks pada halaman ini.",
            "tidak ada teks arab yang terlihat pada halaman ini.",
        ),
    },
    "validator": {
        "en": ("(no english text on this page)", "(no english text on this page.)", "there is no text on this page."),
        "id": ("(tidak ada teks pada halaman ini)", "(tidak ada teks pada halaman ini.)", "tidak ada teks pada halaman ini."),
    },
}
# Function words that tell the two target languages apart.
MARKERS = {
    "id": (
        "yang", "dan", "tidak", "ada", "ini", "dengan", "untuk", "adalah", "pada", "akan", "dalam", "halaman", "dari", "ke", "di",
        "itu", "atau", "juga", "sudah", "bagi", "kepada", "kepadanya", "maka", "pun", "punlah",
    ),
    "en": (
        "the", "and", "not", "this", "with", "for", "is", "that", "was", "were", "of", "to", "in", "it", "he", "she", "they",
        "which", "as", "be", "has", "have", "said", "his", "her", "their", "upon", "from", "there",
    ),
}


def starts(spark: SparkSession, rows, schema: str = "chapter_num int, start_page long, slug string") -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def chapters(spark: SparkSession) -> DataFrame:
    """chapter_num, start_page, end_page, slug, with front matter as chapter 0."""
    return bounds(starts(spark, ((0, 0, "front_matter"), *CHAPTERS)), "start_page", "end_page")


def sections(spark: SparkSession) -> DataFrame:
    return bounds(starts(spark, SECTIONS, "section_id int, start_page long"), "start_page", "end_page")


def parts(spark: SparkSession) -> DataFrame:
    return bounds(starts(spark, PARTS, "part_id string, start_page long"), "start_page", "end_page")


def bounds(dim: DataFrame, start: str, end: str) -> DataFrame:
    """dim with each row's last page: the next start less one; the last is open. One window over a dimension's few rows."""
    return dim.withColumn(end, F.lead(start).over(W.partitionBy(F.lit(0)).orderBy(start)) - 1)


def tail_titles(spark: SparkSession) -> DataFrame:
    """(page, title struct) of the last pages."""
    return spark.createDataFrame([(p, tuple(t[g] for g in ("ar", "en", "id"))) for p, t in TAIL_TITLES.items()], "page long, title struct<ar:string,en:string,id:string>")


def candidates(spark: SparkSession) -> DataFrame:
    """(layer, page) whose work is classified one by one."""
    return spark.createDataFrame(list(CANDIDATES), "layer string, page long")


def figures(spark: SparkSession) -> DataFrame:
    """(figure, page, after_block, size) of the printed edition."""
    return spark.createDataFrame(list(FIGURES), "figure int, page long, after_block int, size string")
