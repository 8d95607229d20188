"""Country of each flight destination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Destination, country. Some pairs look odd (sydney and london in canada, rome, florence and melbourne
# in the usa); they follow the airports the flights really use and are kept as given.
DESTINATION_COUNTRIES = [
    ("buenos aires", "argentina"),
    ("agra", "india"),
    ("auckland", "new zealand"),
    ("amsterdam", "netherlands"),
    ("atlanta", "usa"),
    ("abu dhabi", "united arab emirates"),
    ("austin", "usa"),
    ("antalya", "turkey"),
    ("barcelona", "spain"),
    ("seattle", "usa"),
    ("el paso", "usa"),
    ("bangkok", "thailand"),
    ("bangalore", "india"),
    ("nashville", "usa"),
    ("boston", "usa"),
    ("brussels", "belgium"),
    ("budapest", "hungary"),
    ("baltimore", "usa"),
    ("sydney", "canada"),
    ("cairo", "egypt"),
    ("guangzhou", "china"),
    ("paris", "france"),
    ("charlotte", "usa"),
    ("colombo", "sri lanka"),
    ("columbus", "usa"),
    ("casablanca", "morocco"),
    ("cape town", "south africa"),
    ("chengdu", "china"),
    ("dallas", "usa"),
    ("washington", "usa"),
    ("delhi", "india"),
    ("denver", "usa"),
    ("detroit", "usa"),
    ("dalian", "china"),
    ("tucson", "usa"),
    ("denpasar", "indonesia"),
    ("dublin", "ireland"),
    ("durban", "south africa"),
    ("dubai", "united arab emirates"),
    ("edinburgh", "united kingdom"),
    ("houston", "usa"),
    ("fresno", "usa"),
    ("rome", "usa"),
    ("florence", "usa"),
    ("fort worth", "usa"),
    ("fukuoka", "japan"),
    ("rio de janeiro", "brazil"),
    ("seoul", "south korea"),
    ("geneva", "switzerland"),
    ("hamburg", "germany"),
    ("hanoi", "vietnam"),
    ("heraklion", "greece"),
    ("hong kong", "china"),
    ("phuket", "thailand"),
    ("johannesburg", "south africa"),
    ("jakarta", "indonesia"),
    ("hamilton", "canada"),
    ("tokyo", "japan"),
    ("honolulu", "usa"),
    ("hurghada", "egypt"),
    ("indianapolis", "usa"),
    ("istanbul", "turkey"),
    ("osaka", "japan"),
    ("jaipur", "india"),
    ("jacksonville", "usa"),
    ("new york", "usa"),
    ("johor bahru", "malaysia"),
    ("jerusalem", "israel"),
    ("kuala lumpur", "malaysia"),
    ("guilin", "china"),
    ("las vegas", "usa"),
    ("los angeles", "usa"),
    ("london", "canada"),
    ("milan", "italy"),
    ("lisbon", "portugal"),
    ("lagos", "nigeria"),
    ("louisville", "usa"),
    ("phoenix", "usa"),
    ("madrid", "spain"),
    ("orlando", "usa"),
    ("chicago", "usa"),
    ("melbourne", "usa"),
    ("memphis", "usa"),
    ("mexico city", "mexico"),
    ("macau", "china"),
    ("miami", "usa"),
    ("milwaukee", "usa"),
    ("manila", "philippines"),
    ("munich", "germany"),
    ("naples", "italy"),
    ("nice", "france"),
    ("san diego", "usa"),
    ("oklahoma city", "usa"),
    ("portland", "usa"),
    ("beijing", "china"),
    ("philadelphia", "usa"),
    ("pune", "india"),
    ("prague", "czechia"),
    ("punta cana", "dominican republic"),
    ("copenhagen", "denmark"),
    ("san antonio", "usa"),
    ("riyadh", "saudi arabia"),
    ("san francisco", "usa"),
    ("ho chi minh city", "vietnam"),
    ("shanghai", "china"),
    ("singapore", "singapore"),
    ("san jose", "usa"),
    ("moscow", "russia"),
    ("berlin", "germany"),
    ("shenzhen", "china"),
    ("qingdao", "china"),
    ("taipei", "taiwan"),
    ("venice", "italy"),
    ("vienna", "austria"),
    ("warsaw", "poland"),
    ("xi'an", "china"),
    ("winnipeg", "canada"),
    ("edmonton", "canada"),
    ("montreal", "canada"),
    ("toronto", "canada"),
    ("ottawa", "canada"),
    ("quebec", "canada"),
    ("vancouver", "canada"),
    ("calgary", "canada"),
]


def destination_countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DESTINATION_COUNTRIES, "destination string, destination_country string")
