"""Labels, sort ranks and groups shown on the dashboard."""

from __future__ import annotations

# Result-reporting code, label, rank.
RESULTS_REPORTING = (
    ("results_timely", "Trial reported summary results on time", 1),
    ("results_due_late", "Trial reported summary results late", 2),
    ("results_due_missing", "Trial summary results due but not reported", 3),
    ("results_not_due", "Trial not yet due to report results", 4),
)

# Work type and label. The fifth key is spelled as the output contract has it.
WORK_TYPES = (
    ("journal-article", "Journal articles"),
    ("book-chapter", "Book chapter"),
    ("posted-content", "Preprint"),
    ("book", "Book"),
    ("mongraphs", "Book"),
    ("proceedings-article", "Conference proceedings"),
)

# Open-access route (flag name), label, rank.
ACCESS_ROUTES = (
    ("publisher_only", "Publisher Open Access", 0),
    ("both", "Both", 1),
    ("other_platform_only", "Other Platform Open Access", 2),
)
CLOSED_ACCESS = ("Closed Access", 3)

# Months of embargo below which the row applies, label, rank.
EMBARGO_STEPS = (
    (0, "Green Open Access prior to published date", 6),
    (3, "Immediately available", 1),
    (8, "Open Access before six months", 2),
    (14, "Open Access before twelve months", 3),
    (26, "Open Access before two years", 4),
)
EMBARGO_BEYOND = ("Open Access after two years", 5)
EMBARGO_UNKNOWN = ("Insufficient Data", 99)

# Licence code, label, group. The rank is the position, from 1.
LICENSES = (
    ("pd", "Public Domain", "No restrictions"),
    ("cc0", "CC0", "No restrictions"),
    ("cc-by", "CC-BY", "Attribution required"),
    ("cc-by-sa", "CC-BY-SA", "Share-alike"),
    ("cc-by-nd", "CC-BY-ND", "No derivatives"),
    ("cc-by-nc", "CC-BY-NC", "Non-commercial"),
    ("cc-by-nc-sa", "CC-BY-NC-SA", "Non-commercial"),
    ("cc-by-nc-nd", "CC-BY-NC-ND", "No derivatives"),
    ("publisher-specific-oa", "Publisher-specific: OA license", "Publisher-specific license"),
    (
        "acs-specific: authorchoice/editors choice usage agreement",
        "ACS-specific: Author-choice/Editor's-choice Usage Agreement",
        "Publisher-specific license",
    ),
    (
        "elsevier-specific: oa user license",
        "Elsevier-specific: OA User License",
        "Publisher-specific license",
    ),
    (
        "publisher-specific, author manuscript",
        "Publisher-specific: Author Manuscript",
        "Publisher-specific license",
    ),
    ("other-oa", "Other OA license", "Miscellaneous open license"),
    ("implied-oa", "Free to read (no identified license)", "Free to read"),
    ("unspecified-oa", "Unspecified OA license", "Free to read (license unclear)"),
    ("mit", "MIT License", "Software/open-source license"),
)
LICENSE_UNKNOWN = ("No licence info", 99)
