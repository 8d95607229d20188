"""Output columns of each registered query with their kind, used by Spark and by the check SQL alike.

Kinds: i integer, d double, b boolean, s string.
"""

from __future__ import annotations

_USER_TOTALS = {
    "user_browsing_totals": """
        total_min_sessions:d total_min_booking:d total_min_cancellation:d total_min_browsing:d total_page_clicks:i
        total_clicks_booking:i total_clicks_cancellation:i total_clicks_browsing:i total_sessions:i total_browsing_only:i""",
    "user_booking_totals": """
        total_bookings:i total_cancellations:i valid_combined_bookings:i valid_flight_bookings:i flight_bookings_only:i
        domestic_flight_bookings:i international_flight_bookings:i intercontinental_flight_bookings:i
        valid_hotel_bookings:i hotel_bookings_only:i""",
    "user_price_totals": """
        discount_flight_bookings:i avg_flight_discount:d sum_flight_price_per_km:d discount_hotel_bookings:i
        avg_hotel_discount:d sum_hotel_price_per_night:d sum_discount_bookings:i""",
    "user_seat_room_night_totals": """
        valid_seats:i single_seat_bookings:i valid_bags:i no_bag_bookings:i valid_rooms:i one_room_bookings:i
        single_room_bookings:i double_room_bookings:i nights_combined_flight_hotel:i nights_flight_total:i
        nights_hotel_only:i nights_flight_only:i short_weekday_trips:i weekend_trips:i sum_leadtime_flight_hotel:i
        sum_leadtime_hotel_only:i sum_leadtime_flight_only:i""",
    "user_info_totals": """
        age:i is_married:i has_children:i last_booking_since_signup:i last_session_since_signup:i""",
    "user_averages": """
        is_in_working_age:i avg_min_per_session:d avg_min_booking:d avg_min_cancellation:d avg_min_browsing:d
        avg_page_clicks:d avg_clicks_booking:d avg_clicks_cancellation:d avg_clicks_browsing:d valid_bookings:i
        avg_flight_price_per_km:d avg_hotel_price_per_night:d avg_seats:d avg_bags:d avg_rooms:d avg_nights_combined:d
        avg_nights_flight_total:d avg_nights_hotel_only:d avg_nights_flight_only:d avg_nights_total:d
        weekdays_travel_quote:d weekend_travel_quote:d avg_leadtime_combined:d avg_leadtime_hotel_only:d
        avg_leadtime_flight_only:d""",
}

_FEATURES = {
    "feature_minmax": "avg_bags_norm_invert:d avg_seats_norm_invert:d avg_nights_total_norm_invert:d",
    "feature_percentile_flags": """
        is_quick_booker_p20:i is_slow_booker_p80:i is_low_clicks_booker_p20:i is_high_clicks_booker_p80:i
        is_short_leadtime_p20:i is_frequent_traveler_p80:i is_high_price_flight_p80:i is_budget_price_flight_p20:i
        is_high_price_hotel_p80:i is_budget_price_hotel_p20:i""",
    "feature_conditions_quotes": """
        is_dreamer_no_bookings:i is_new_customer_booking:i has_middle_num_seats:i has_middle_num_bags:i
        has_middle_num_rooms:i is_senior_traveler:i is_young_traveler:i discount_booking_quote:d discount_flight_quote:d
        discount_hotel_quote:d domestic_flight_quote:d international_flight_quote:d intercontinental_flight_quote:d""",
}

_SESSIONS = {
    "cohort_sessions": "user_id:i trip_id:i page_clicks:i cancellation:b",
    "session_join": """
        user_id:i trip_id:i married:b home_country:s home_airport:s trip_airline:s destination:s seats:i checked_bags:i
        base_fare_usd:d hotel_name:s nights:i rooms:i hotel_per_room_usd:d destination_country:s""",
    "session_cleaning": """
        nights_cleaned:i flight_discount_cleaned:b hotel_discount_cleaned:b flight_booked_cleaned:b
        hotel_booked_cleaned:b""",
    "hotel_city": "hotel_city:s",
    "session_time_features": """
        session_duration_min:d departure_dow:i return_dow:i check_in_dow:i flight_trip_length:i age_years:i""",
    "flight_distance": "flight_distance_km:d flight_distance_category:s",
    "session_categories": """
        trip_status:s age_group:s booking_category:s stay_length:s season_hotel:s season_flight:s
        flight_destination_category:s""",
    "session_click_duration_split": """
        clicks_per_min:d clicks_hotel_only:i clicks_flight_only:i clicks_flight_hotel:i clicks_browsing_only:i
        clicks_booking:i clicks_cancellation:i clicks_browsing:i session_duration_booking:d
        session_duration_cancellation:d session_duration_browsing:d""",
    "lead_times": "leadtime_flight_hotel_combined:i leadtime_hotel_only:i leadtime_flight_only:i",
    "trip_length_flags": """
        dow_check_out_cleaned:i flight_trip_nights:i flight_trip_days:i is_weekender_flight:b is_weekender_hotel:b
        is_short_weekday_flight:b is_short_weekday_hotel:b""",
    "flight_pricing": "flight_price_per_seat:d flight_price_per_km:d",
}

_SCORES = [
    "score_business",
    "score_family",
    "score_frequent_traveler",
    "score_new_booking_customer",
    "score_dreamer",
    "score_young_traveler",
    "score_premium_traveler",
    "score_budget_traveler",
    "score_deal_hunter",
]

_KPIS = """
    sessions:i trips_booked:i active_users:i new_users:i total_users:i dormant_users:i growth_sessions_pct:d
    growth_trips_pct:d growth_active_users_pct:d growth_new_users_pct:d growth_total_users_pct:d
    session_to_booking_conv_pct:d trips_per_active_user:d sessions_per_active_user:d repeat_booker_share_pct:d
    active_user_rate_pct:d booker_rate_pct:d dormant_rate_pct:d"""
_SUMMARY = "final_segment:s users:i share_perc:d good_match_perc:d perk:s"
_RETENTION = """
    cohort_type:s cohort_year_ytd:i compare_year_ytd:i cohort_size:i retained_users:i retention_rate_pct:d"""
_YEARLY = {
    "sessions_by_year": "year:i sessions:i active_users:i trips_booked:i",
    "repeat_bookers_by_year": "year:i repeat_bookers:i bookers_total:i",
    "trips_per_user_year": "year:i user_id:i trips_user_year:i",
    "new_users_by_year": "year:i new_users:i",
    "total_users_by_year": "year:i total_users:i",
}

_TEXT = {
    **{name: "session_id:i " + columns for name, columns in _SESSIONS.items()},
    "session_base": "session_id:i " + " ".join(c for n, c in _SESSIONS.items() if n != "cohort_sessions"),
    "session_inspection": "session_id:i user_id:i " + " ".join(c for n, c in _SESSIONS.items() if n != "cohort_sessions"),
    "user_inspection": "user_id:i " + _USER_TOTALS["user_averages"],
    "trip_status": "trip_id:i trip_status:s",
    **{name: "user_id:i " + columns for name, columns in {**_USER_TOTALS, **_FEATURES}.items()},
    "percentile_limits": _FEATURES["feature_percentile_flags"].replace(":i", ":d"),
    "user_scores": "user_id:i " + " ".join(f"{s}:d" for s in _SCORES),
    "user_scores_tall": "user_id:i segment:s score:d",
    "assigned_segments": "user_id:i assigned_segment:s score:d final_segment:s",
    "assignment_inspection": "user_id:i assigned_segment:s score:d",
    "segment_summary": _SUMMARY,
    "segment_summary_short": _SUMMARY,
    "segment_summary_extended": _SUMMARY,
    **_YEARLY,
    **{f"{name}_ytd": columns for name, columns in _YEARLY.items()},
    "ytd_cutoff": "max_sess_date:s m:i d:i",
    "kpi_full_year": "the_year:i " + _KPIS,
    "kpi_ytd": "ytd_year:i " + _KPIS,
    "kpi_dashboard": """
        ytd_year:i total_users:i new_users:i active_users:i trips_booked:i sessions:i trips_per_active_user:d
        growth_total_users_pct:d growth_new_users_pct:d growth_active_users_pct:d growth_trips_pct:d
        growth_sessions_pct:d""",
    "retention_active": _RETENTION,
    "retention_booker": _RETENTION,
    "retention_heatmap": _RETENTION,
}

COLUMNS: dict[str, list[tuple[str, str]]] = {
    name: [tuple(item.split(":")) for item in text.split()] for name, text in _TEXT.items()
}
