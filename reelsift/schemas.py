"""Declared table layouts, in the notation of DDL."""

RAW_TRENDING = (
    "video_id string, title string, publishedAt timestamp, channelId string, channelTitle string, "
    "categoryId int, trending_date timestamp, tags string, view_count bigint, likes bigint, "
    "dislikes bigint, comment_count bigint, thumbnail_link string, comments_disabled boolean, "
    "ratings_disabled boolean, category_name string, country_dataset string"
)
VIDEO_ENRICHED = (
    "video_id string, title string, published_at timestamp, channel_id string, channel_title string, "
    "category_id int, trending_date timestamp, tags array<string>, view_count bigint, likes bigint, "
    "dislikes bigint, comment_count bigint, thumbnail_link string, comments_disabled boolean, "
    "ratings_disabled boolean, category_name string, country_dataset string, is_scraped int, "
    "default_language string, duration string, caption string, licensed_content boolean, "
    "region_restriction map<string, array<string>>, content_rating map<string, string>"
)
VIDEO_DETAILS = (
    "video_id string, tags array<string>, default_language string, duration string, caption string, "
    "licensed_content boolean, region_restriction map<string, array<string>>, "
    "content_rating map<string, string>, is_scraped int"
)

CATALOGUE_BRONZE = (
    "show_id string, category string, age_required int, title string, director string, `cast` string, "
    "countries string, date_added date, release_year int, duration string, genres string, "
    "is_animation string, platform string, is_scraped string, last_updated_date date"
)
CATALOGUE_WITH_IDS = (
    "show_id string, category string, age_required int, title string, director string, `cast` string, "
    "countries string, date_added date, release_date int, duration string, genres string, "
    "is_animation string, platform string, is_scraped string, last_updated_date date, imdb_id string"
)
CATALOGUE_ENRICHED = (
    "show_id string, category string, age_required int, title string, director string, `cast` string, "
    "countries string, date_added date, release_date string, duration string, genres string, "
    "is_animation string, platform string, is_scraped string, last_updated_date date, imdb_id string, "
    "rating string, votes string, languages string, color string, top_250 string, box_office string, "
    "production_companies string, writers string, series_years string"
)
CATALOGUE_CLEANED = (
    "show_id string, category string, age_required int, title string, director string, `cast` string, "
    "countries string, date_added date, release_date date, genres string, is_animation string, "
    "platform string, is_scraped string, imdb_id string, rating double, votes string, languages string, "
    "color string, top_250 string, production_companies string, writers string, last_updated_date date, "
    "duration_minutes int, duration_seasons int, first_series_years int, last_series_years int, "
    "budget_eur double, opening_weekend_eur double, cumulative_worldwide_gross_eur double"
)
