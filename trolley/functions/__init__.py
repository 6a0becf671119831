from trolley.functions.labels import (normalise_label, segment, season_of_month, date_key,
                                      iso_weekday, year_month, clip)
from trolley.functions.itemsets import itemset_to_text, text_to_itemset

__all__ = ["normalise_label", "segment", "season_of_month", "date_key", "iso_weekday",
           "year_month", "clip", "itemset_to_text", "text_to_itemset"]
