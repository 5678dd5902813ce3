"""Schemas of the snapshot files and of the source dimension."""

from pyspark.sql import DataFrame, SparkSession

SIGNAL = """externalId string, url string, title string, summary string, author string, language string, publishedAt string, category string, tags array<string>,
metrics struct<platforms: array<string>>, rawMeta struct<adapter: string, source: string, type: string, dateInferred: boolean, dataSource: string, datasetId: string>,
sourceSlug string, sourceName string"""
SNAPSHOT = f"collectedAt string, signals array<struct<{SIGNAL.replace(' string', ': string').replace(' array<string>', ': array<string>').replace('metrics struct', 'metrics: struct').replace('rawMeta struct', 'rawMeta: struct').replace(':: ', ': ')}>>"

# Display order of the categories.
CATEGORIES = ["racing", "local-market", "new-models", "tech", "industry", "culture"]

# Slug, adapter, language, category, url, authority, primary.
SOURCES = [
    ("motogp-news", "web-scraper", "en", "racing", "https://www.motogp.com/en/news", 95, True),
    ("worldsbk-news", "web-scraper", "en", "racing", "https://www.worldsbk.com/en/news", 95, True),
    ("speedweek-motogp", "web-scraper", "de", "racing", "https://www.speedweek.com/o/motorrad-gp/motogp", 82, False),
    ("lta-coe-motorcycle", "lta-coe", "en", "local-market", "https://data.gov.sg/datasets/d_69b3380ad7e51aff3a7dcc84eba52b8a/view", 95, True),
    ("boon-siew-honda", "web-scraper", "en", "local-market", "https://boonsiewhonda.com.my/news-and-events/news/", 80, True),
    ("modenas-emos", "web-scraper", "en", "local-market", "https://modenas.my/news&event/press-release", 80, True),
    ("mah-pte-ltd", "web-scraper", "en", "local-market", "https://mah.com.sg/brands-kawasaki/", 80, True),
    ("rideapart", "rss", "en", "new-models", "https://www.rideapart.com/rss/articles/all/", 75, False),
    ("cycleworld", "web-scraper", "en", "new-models", "https://www.cycleworld.com/", 80, False),
    ("visordown", "web-scraper", "en", "new-models", "https://www.visordown.com/news", 75, False),
    ("honda-global-news", "web-scraper", "en", "tech", "https://global.honda/en/motorcycle/brand/news/", 90, True),
    ("yamaha-global-news", "web-scraper", "en", "tech", "https://global.yamaha-motor.com/news/", 90, True),
    ("lianglunshijie-industry", "web-scraper", "zh", "industry", "https://www.lianglunshijie.com/htmlry/hysj_1201.html", 55, False),
    ("eicma", "web-scraper", "en", "culture", "https://www.eicma.it/en/news/", 85, True),
    ("bangkok-motor-show", "web-scraper", "en", "culture", "https://motorshow.in.th/", 80, True),
    ("kompas-otomotif", "web-scraper", "id", "culture", "https://otomotif.kompas.com/", 65, False),
]
SOURCE = "source_slug string, adapter string, language string, category string, url string, authority int, is_primary boolean"

# The names of the sources.
NAMES = {
    "motogp-news": "MotoGP 官方新闻",
    "worldsbk-news": "WorldSBK 官方新闻",
    "speedweek-motogp": "SPEEDWEEK.com（MotoGP 板块）",
    "lta-coe-motorcycle": "新加坡 LTA COE 摩托车类别（Category D）投标结果",
    "boon-siew-honda": "Boon Siew Honda",
    "modenas-emos": "MODENAS/EMOS（马来西亚 Kawasaki 官方总代理）",
    "mah-pte-ltd": "Mah Pte Ltd（新加坡 Kawasaki 等六品牌独家代理）",
    "rideapart": "RideApart",
    "cycleworld": "Cycle World",
    "visordown": "Visordown",
    "honda-global-news": "Honda Global 摩托车新闻室",
    "yamaha-global-news": "Yamaha Motor Global News Center",
    "lianglunshijie-industry": "两轮视界·行业数据",
    "eicma": "EICMA（米兰国际两轮车展）",
    "bangkok-motor-show": "Bangkok International Motor Show",
    "kompas-otomotif": "Kompas.com Otomotif",
}
# Homepages that are not the address itself.
HOMEPAGES = {"rideapart": "https://www.rideapart.com/"}


def sources(spark: SparkSession) -> DataFrame:
    """The dimension with source_name and homepage_url."""
    return spark.createDataFrame([(*s, NAMES[s[0]], HOMEPAGES.get(s[0], s[4])) for s in SOURCES], f"{SOURCE}, source_name string, homepage_url string")
