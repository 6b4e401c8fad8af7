"""Source and meaning of every column of the enriched listing table."""

COLUMNS = {
    "id": ("Listings", "Unique listing number"),
    "latitude": ("Listings", "Latitude in degrees"),
    "longitude": ("Listings", "Longitude in degrees"),
    "price": ("Listings", "Price per night, cleaned and kept between 20 and 500"),
    "accommodates": ("Listings", "Guests at most"),
    "bedrooms": ("Listings", "Bedrooms"),
    "beds": ("Listings", "Beds"),
    "bathrooms": ("Listings", "Bathrooms"),
    "room_type": ("Listings", "Kind of room"),
    "property_type": ("Listings", "Kind of property"),
    "neighbourhood_cleansed": ("Listings", "Borough as published"),
    "name": ("Listings", "Title"),
    "description": ("Listings", "Free text; empty when missing"),
    "amenities": ("Listings", "Comma-separated amenities"),
    "review_scores_rating": ("Listings", "Guest rating from 0 to 5"),
    "number_of_reviews": ("Listings", "Reviews so far"),
    "reviews_per_month": ("Listings", "Reviews per month"),
    "availability_365": ("Listings", "Free days in the next 365"),
    "availability_30": ("Listings", "Free days in the next 30"),
    "host_is_superhost": ("Listings", "Host has superhost status"),
    "host_response_rate": ("Listings", "Host response rate in percent"),
    "host_acceptance_rate": ("Listings", "Host acceptance rate in percent"),
    "area": ("Engineered", "Borough in lower case; joins crime and income"),
    "has_description": ("Engineered", "1 when there is a description"),
    "price_per_person": ("Engineered", "Price by guests; not for models"),
    "is_central_london": ("Engineered", "1 when the latitude is between 51.50 and 51.52"),
    "desc_length": ("Engineered", "Characters of the description"),
    "has_luxury_words": ("Engineered", "1 when the description has a luxury word"),
    "has_balcony": ("Engineered", "1 when a balcony is listed"),
    "has_view": ("Engineered", "1 when a view is listed"),
    "has_garden": ("Engineered", "1 when a garden is listed"),
    "has_hot_tub": ("Engineered", "1 when a hot tub or jacuzzi is listed"),
    "property_room_combo": ("Engineered", "Property type and room type"),
    "luxury_score": ("Engineered", "0.4 bathrooms + 0.3 guests + 0.2 bedrooms"),
    "dominant_season": ("Calendar", "Season with the most booked days"),
    "area_crime_count": ("Crime", "Crimes recorded in the borough"),
    "stations_within_1km": ("Stations", "Stations at most 1 km away"),
    "tourist_spots_within_1km": ("Tourist spots", "Tourist spots at most 1 km away"),
    "house_price": ("Area figures", "Mean of the median house prices of the borough"),
    "income": ("Area figures", "Mean household income of the borough"),
}
