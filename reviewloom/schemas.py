"""Table and file schemas. Empty text means missing; ratings and prices are decimals."""

from __future__ import annotations

VENDORS = """
  id BIGINT, source STRING, source_vendor_id STRING, source_url STRING, name STRING, category STRING,
  city STRING, state STRING, phone STRING, email STRING, website_url STRING,
  starting_price_min DECIMAL(10,2), starting_price_avg DECIMAL(10,2), starting_price_range STRING, price_tier STRING,
  star_rating DECIMAL(3,1), review_count INT, description STRING, headline STRING, ad_tier STRING, vendor_tier STRING,
  claimed_status STRING, service_area STRING, year_founded INT, team_size INT, travel_distance INT,
  facebook_url STRING, instagram_username STRING, pinterest_username STRING,
  awards ARRAY<STRUCT<name: STRING>>, deals ARRAY<STRUCT<description: STRING>>,
  first_seen TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ, scrape_run_id BIGINT, raw_data STRING
"""

REVIEWS = """
  id BIGINT, vendor_id BIGINT, source STRING, source_review_id STRING, source_vendor_id STRING,
  review_text STRING, review_title STRING, reviewer_name STRING, reviewer_location STRING,
  rating DECIMAL(3,1), review_date DATE, sentiment STRING, sentiment_confidence DECIMAL(5,4),
  complaint_categories ARRAY<STRING>, praise_categories ARRAY<STRING>,
  complaint_points ARRAY<STRUCT<category: STRING, quote: STRING>>,
  praise_points ARRAY<STRUCT<category: STRING, quote: STRING>>,
  ai_analysis STRING, analyzed_at TIMESTAMP_NTZ, analysis_model STRING, scraped_at TIMESTAMP_NTZ,
  first_seen TIMESTAMP_NTZ, raw STRING, is_vendor_reply BOOLEAN
"""

RUNS = """
  id BIGINT, source STRING, category STRING, city STRING, state STRING, started_at TIMESTAMP_NTZ,
  completed_at TIMESTAMP_NTZ, vendors_found INT, vendors_successful INT, status STRING, notes STRING
"""

PRICING_RECORD = """
  source STRING, source_url STRING, vendor_id STRING, name STRING, category STRING, category_detail STRING,
  phone STRING, email STRING, website_url STRING, city STRING, state STRING, service_area STRING,
  starting_price_min DOUBLE, starting_price_avg DOUBLE, starting_price_range STRING, price_tier STRING,
  star_rating DOUBLE, review_count INT, ad_tier STRING, vendor_tier STRING, claimed_status STRING,
  deal_count INT, deal_descriptions ARRAY<STRING>, awards ARRAY<STRUCT<name: STRING>>, year_founded INT,
  team_size INT, peak_price_min DOUBLE, peak_price_avg DOUBLE, offpeak_price_min DOUBLE, offpeak_price_avg DOUBLE,
  description_snippet STRING, scraped_at STRING, scrape_success BOOLEAN
"""

# Column order of the pricing CSV.
PRICING_CSV_COLUMNS = [
    "source", "category", "category_detail", "name", "phone", "email", "website_url",
    "city", "state", "starting_price_min", "starting_price_avg", "starting_price_range",
    "price_tier", "star_rating", "review_count", "ad_tier", "vendor_tier",
    "deal_count", "year_founded", "team_size", "source_url", "scrape_success",
]

_PACKAGES = "ARRAY<STRUCT<package_number: INT, name: STRING, price: STRING, description: STRING>>"
PACKAGE_FILE = f"name STRING, packages {_PACKAGES}, prices_found ARRAY<STRING>, starting_prices_raw ARRAY<STRING>"
DIRECT_PACKAGE_FILE = f"""name STRING, packages {_PACKAGES}, prices_clean ARRAY<STRING>, prices ARRAY<STRING>,
  phone STRING, description STRING, pages_ok INT, url STRING"""
WEBSITE_ENTRY = "STRUCT<phone: STRING, website_url: STRING>"

REQUEST_LOG = """
  source STRING, url STRING, status STRING, html_size BIGINT, elapsed DOUBLE, title STRING, error STRING,
  blocks_detected ARRAY<STRING>, ts TIMESTAMP, idx BIGINT, phase STRING, delay DOUBLE, vendor STRING,
  html_mb DOUBLE, blocked BOOLEAN, reason STRING
"""
