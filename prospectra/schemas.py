"""Schemas of the tables and records, as DDL text."""

from __future__ import annotations

PLACE = (
    "place_id string, title string, link string, web_site string, phone string, address string, "
    "complete_address struct<city:string,state:string,postal_code:string>, latitude double, longitude double, "
    "review_rating double, review_count int, category string, categories array<string>, description string, "
    "open_hours map<string,array<string>>, price_range string, status string, "
    "about array<struct<options:array<struct<name:string,enabled:boolean>>>>, "
    "order_online array<struct<link:string,source:string>>, "
    "user_reviews array<struct<published_at:string>>, _corrupt string"
)

QUERY_META = "keyword string, geo_target string, service_category string, phase string"

STAGING = (
    "place_id string, domain string, phone_normalized string, name_city_state_key string, name string, "
    "maps_url string, website string, phone string, address string, city string, state string, zip string, "
    "latitude double, longitude double, rating double, review_count int, primary_category string, "
    "categories array<string>, description string, hours string, price_range string, status string, "
    "service_category string, icp_score int, icp_tier string, qc_status string, query string, "
    "geo_target string, phase string"
)

BUSINESS = (
    "id string, place_id string, domain string, phone_normalized string, name_city_state_key string, name string, "
    "maps_url string, website string, phone string, address string, city string, state string, zip string, "
    "latitude double, longitude double, rating double, review_count int, primary_category string, "
    "categories array<string>, description string, hours string, price_range string, status string, "
    "service_category string, icp_score int, icp_tier string, qc_status string, "
    "date_discovered timestamp, date_updated timestamp"
)

PROVENANCE = "id string, query string, geo_target string, service_category string, phase string, discovered_at timestamp"

SEARCH_LOG = (
    "query string, geo_target string, service_category string, phase string, searched_at timestamp, "
    "results_discovered long, new_businesses long, duplicates long, qualified long, rejected long"
)

EVENT = (
    "id string, event_type string, organization_id string, created_at string, "
    "data struct<challenge:string,subject:string,preview:string,email:string,name:string,id:string>"
)

HEALTH_TICK = "fleet string, checked_at timestamp, verdict string, action string, action_ok boolean"

QC_STATUSES = ("VALID", "NEEDS_ENRICHMENT", "LOW_PRIORITY", "REJECTED", "CLOSED")
OUTREACH_STATUSES = ("claimed", "rejected", "imported", "failed")
