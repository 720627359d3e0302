"""Fixed values of the two query matrices: lists, query texts and descriptions, in matrix order."""

# List entries, `fine` scheme. The `coarse` scheme uses the first 41 languages and first 20 topics.
LANGUAGES = """
javascript python java typescript go rust php c++ c# ruby swift kotlin scala dart r objective-c perl haskell lua
clojure f# erlang elixir crystal nim julia zig v assembly shell powershell makefile dockerfile html css scss less vue
svelte coffeescript livescript ocaml racket scheme forth prolog cobol fortran pascal ada vhdl verilog matlab
mathematica tex nix
""".split()
COARSE_LANGUAGES = LANGUAGES[:41]

STAR_BANDS = """
0..0 1..1 2..2 3..3 4..4 5..5 6..6 7..7 8..8 9..9 10..10 11..11 12..12 13..13 14..14 15..15 16..16 17..17 18..18
19..19 20..20 21..21 22..22 23..23 24..24 25..25 26..27 28..29 30..31 32..34 35..37 38..41 42..45 46..50 51..55 56..62
63..70 71..79 80..89 90..100 101..115 116..132 133..152 153..175 176..202 203..233 234..270 271..313 314..364 365..425
426..497 498..582 583..682 683..800 801..938 939..1100 1101..1290 1291..1515 1516..1780 1781..2090 2091..2457
2458..2890 2891..3400 3401..4000 4001..4700 4701..5520 5521..6490 6491..7630 7631..8970 8971..10550 10551..12410
12411..14600 14601..17160 17161..20170 20171..23700 23701..27880 27881..32790 32791..38560 38561..45350 >45350
""".split()
COARSE_STAR_BANDS = """
0..2 3..5 6..10 11..15 16..25 26..40 41..60 61..90 91..130 131..180 181..250 251..350 351..500 501..700 701..1000
1001..1400 1401..2000 2001..3000 3001..4500 4501..7000 7001..10000 10001..15000 15001..25000 25001..50000 >50000
""".split()

DATE_BANDS = """
2024-12-01..2025-12-31 2024-11-01..2024-11-30 2024-10-01..2024-10-31 2024-09-01..2024-09-30 2024-08-01..2024-08-31
2024-07-01..2024-07-31 2024-06-01..2024-06-30 2024-05-01..2024-05-31 2024-04-01..2024-04-30 2024-03-01..2024-03-31
2024-02-01..2024-02-29 2024-01-01..2024-01-31 2023-10-01..2023-12-31 2023-07-01..2023-09-30 2023-04-01..2023-06-30
2023-01-01..2023-03-31 2022-10-01..2022-12-31 2022-07-01..2022-09-30 2022-04-01..2022-06-30 2022-01-01..2022-03-31
2021-10-01..2021-12-31 2021-07-01..2021-09-30 2021-04-01..2021-06-30 2021-01-01..2021-03-31 2020-07-01..2020-12-31
2020-01-01..2020-06-30 2019-07-01..2019-12-31 2019-01-01..2019-06-30 2018-07-01..2018-12-31 2018-01-01..2018-06-30
2017-01-01..2017-12-31 ..2016-12-31
""".split()
COARSE_DATE_BANDS = """
2024-06-01..2025-12-31 2024-01-01..2024-05-31 2023-07-01..2023-12-31 2023-01-01..2023-06-30 2022-06-01..2022-12-31
2022-01-01..2022-05-31 2021-06-01..2021-12-31 2021-01-01..2021-05-31 2020-01-01..2020-12-31 ..2019-12-31
""".split()

SIZE_BANDS = "<5 5..15 16..50 51..150 151..500 501..1500 1501..5000 >5000".split()
LICENSES = "mit apache-2.0 gpl-3.0 bsd-2-clause bsd-3-clause isc unlicense lgpl-2.1".split()
TOPICS = """
api cli framework library tool web mobile game machine-learning data security blockchain iot ai database monitoring
testing automation devops cloud frontend backend fullstack microservices serverless kubernetes docker react vue angular
""".split()
COARSE_TOPICS = TOPICS[:20]

# Queries without list entries, as (query, description).
SPECIALS = [
    ("is:public fork:false archived:false has:readme stars:0..1 sort:updated", "Active non-forks, documented, 0-1 stars"),
    ("is:public fork:false archived:false has:readme stars:2..3 sort:updated", "Active non-forks, documented, 2-3 stars"),
    ("is:public fork:false archived:false has:readme stars:4..5 sort:updated", "Active non-forks, documented, 4-5 stars"),
    ("is:public fork:false archived:false has:readme stars:6..8 sort:updated", "Active non-forks, documented, 6-8 stars"),
    ("is:public fork:false archived:false has:readme stars:9..12 sort:updated", "Active non-forks, documented, 9-12 stars"),
    ("is:public pushed:>2024-06-01 stars:0..2 sort:updated", "Recently pushed, 0-2 stars"),
    ("is:public pushed:>2024-06-01 stars:3..5 sort:updated", "Recently pushed, 3-5 stars"),
    ("is:public pushed:>2024-06-01 stars:6..10 sort:updated", "Recently pushed, 6-10 stars"),
    ("is:public has:issues has:wiki stars:1..15 sort:updated", "With issues and wiki, 1-15 stars"),
    ("is:public good-first-issues:>0 stars:1..25 sort:updated", "Good first issues, 1-25 stars"),
    ("is:public help-wanted-issues:>0 stars:1..20 sort:updated", "Help wanted issues, 1-20 stars"),
    ("is:public size:<100 stars:1..8 sort:updated", "Small repos, 1-8 stars"),
    ("is:public size:100..1000 stars:1..12 sort:updated", "Medium repos, 1-12 stars"),
    ("is:public template:true stars:1..50 sort:updated", "Template repos, 1-50 stars"),
    ("is:public mirror:false stars:0..3 sort:updated", "Non-mirror repos, 0-3 stars"),
]
COARSE_SPECIALS = [
    ("is:public fork:false archived:false stars:1..20 sort:updated", "Active non-forks"),
    ("is:public has:readme stars:1..50 sort:updated", "Documented repos"),
    ("is:public size:>100 stars:1..30 sort:updated", "Larger repos"),
    ("is:public pushed:>2024-01-01 stars:1..15 sort:updated", "Recently active"),
    ("is:public license:mit stars:1..100 sort:updated", "MIT licensed"),
    ("is:public license:apache-2.0 stars:1..80 sort:updated", "Apache licensed"),
    ("is:public has:issues stars:1..40 sort:updated", "With issues"),
    ("is:public has:wiki stars:1..60 sort:updated", "With documentation"),
]

# The queries of a run with one job only, as (query, description, expected results).
SINGLE_JOB = [
    ("is:public stars:0..2 sort:updated", "Very low stars, recent", 1000),
    ("is:public stars:3..8 sort:stars", "Low stars", 1000),
    ("is:public stars:9..25 sort:updated", "Medium-low stars", 1000),
    ("is:public stars:26..80 sort:stars", "Medium stars", 1000),
    ("is:public stars:81..300 sort:updated", "Higher stars", 1000),
]
COARSE_SINGLE_JOB = [
    ("is:public stars:1..10 sort:updated", "Low star count repositories, recently updated", 1000),
    ("is:public stars:11..50 sort:stars", "Medium star count repositories", 1000),
    ("is:public stars:51..200 sort:updated", "Higher star count repositories", 1000),
    ("is:public stars:>200 sort:stars", "Popular repositories", 1000),
]

# Strategies in the order of job modulo their number. Each has a name, the lists its job number walks
# through (fastest first), and its queries as (query, description, expected results).
STRATEGIES = [
    (
        "language",
        ["language", "stars"],
        [
            (
                "is:public language:{language} stars:{stars} fork:false archived:false sort:updated",
                "Lang+Stars: {language}, {stars} stars",
                900,
            ),
            ("is:public language:{language} stars:{stars} sort:stars", "Fallback: {language}, {stars} stars", 800),
        ],
    ),
    (
        "created",
        ["created", "stars"],
        [
            ("is:public created:{created} stars:{stars} fork:false sort:updated", "Time+Stars: {created}, {stars} stars", 900),
            ("is:public created:{created} stars:{stars} sort:stars", "Time fallback: {created}", 800),
        ],
    ),
    (
        "size",
        ["size", "language", "stars"],
        [
            (
                "is:public size:{size} language:{language} stars:{stars} sort:updated",
                "Size+Lang+Stars: {size}KB, {language}, {stars} stars",
                900,
            ),
            ("is:public size:{size} stars:{stars} sort:updated", "Size fallback: {size}KB", 800),
        ],
    ),
    (
        "topic",
        ["topic", "stars"],
        [
            ("is:public topic:{topic} stars:{stars} fork:false sort:updated", "Topic+Stars: {topic}, {stars} stars", 900),
            ("is:public topic:{topic} sort:stars", "Topic fallback: {topic}", 800),
        ],
    ),
    (
        "license",
        ["license", "language", "stars"],
        [
            (
                "is:public license:{license} language:{language} stars:{stars} sort:updated",
                "License+Lang: {license}, {language}, {stars} stars",
                900,
            ),
            ("is:public license:{license} stars:{stars} sort:stars", "License fallback: {license}", 800),
        ],
    ),
    ("special", ["special"], [("{special}", "Special {job}: {special_description}", 900)]),
]
COARSE_STRATEGIES = [
    (
        "language",
        ["language", "stars"],
        [
            ("is:public language:{language} stars:{stars} sort:updated", "Job {job} - Lang+Stars: {language}, {stars} stars", 400),
            ("is:public language:{language} stars:{stars} sort:stars", "Fallback 1 for job {job}", 300),
            ("is:public stars:{stars} sort:updated", "Fallback 2 for job {job}", 300),
        ],
    ),
    (
        "created",
        ["created", "stars"],
        [
            ("is:public created:{created} stars:{stars} sort:updated", "Job {job} - Time+Stars: {created}, {stars} stars", 400),
            ("is:public created:{created} stars:{stars} sort:stars", "Fallback 1 for job {job}", 300),
            ("is:public stars:{stars} created:{created} fork:false sort:updated", "Fallback 2 for job {job}", 300),
        ],
    ),
    (
        "topic",
        ["topic", "stars"],
        [
            ("is:public topic:{topic} stars:{stars} sort:updated", "Job {job} - Topic+Stars: {topic}, {stars} stars", 400),
            ("is:public topic:{topic} sort:stars", "Fallback 1 for job {job}", 300),
            ("is:public stars:{stars} sort:updated", "Fallback 2 for job {job}", 300),
        ],
    ),
    (
        "special",
        ["special"],
        [
            ("{special}", "Job {job} - Special: {special_description}", 400),
            ("is:public stars:1..25 sort:updated", "Fallback 1 for job {job}", 300),
            ("is:public sort:updated", "Fallback 2 for job {job}", 300),
        ],
    ),
]

# Display names of the licenses in search results, by license key.
LICENSE_NAMES = {
    "mit": "MIT License",
    "apache-2.0": "Apache License 2.0",
    "gpl-3.0": "GNU General Public License v3.0",
    "bsd-2-clause": 'BSD 2-Clause "Simplified" License',
    "bsd-3-clause": 'BSD 3-Clause "New" or "Revised" License',
    "isc": "ISC License",
    "unlicense": "The Unlicense",
    "lgpl-2.1": "GNU Lesser General Public License v2.1",
}
