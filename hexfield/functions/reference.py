"""Reference tables that jobs join: cloud regions and the states' boxes."""

from __future__ import annotations

#: Regions of cloud providers: provider, region, name, latitude, longitude.
CLOUD_REGIONS = [
    ("AWS", "us-east-1", "N. Virginia", 38.9519, -77.4480),
    ("AWS", "us-east-2", "Ohio", 40.4173, -82.9071),
    ("AWS", "us-west-1", "N. California", 37.3861, -122.0839),
    ("AWS", "us-west-2", "Oregon", 45.5231, -122.6765),
    ("AWS", "us-gov-west-1", "GovCloud West", 45.8491, -119.7143),
    ("AWS", "us-gov-east-1", "GovCloud East", 38.9519, -77.4480),
    ("Azure", "eastus", "Virginia", 37.3719, -79.8164),
    ("Azure", "eastus2", "Virginia 2", 36.6681, -78.3889),
    ("Azure", "centralus", "Iowa", 41.5908, -93.6208),
    ("Azure", "northcentralus", "Illinois", 41.8500, -88.0000),
    ("Azure", "southcentralus", "Texas", 29.4167, -98.5000),
    ("Azure", "westcentralus", "Wyoming", 40.8900, -110.3340),
    ("Azure", "westus", "California", 37.7833, -122.4167),
    ("Azure", "westus2", "Washington", 47.2330, -119.8520),
    ("Azure", "westus3", "Arizona", 33.4484, -112.0740),
    ("GCP", "us-east1", "S. Carolina", 33.1960, -80.0131),
    ("GCP", "us-east4", "N. Virginia", 38.9519, -77.4480),
    ("GCP", "us-east5", "Columbus OH", 39.9612, -82.9988),
    ("GCP", "us-central1", "Iowa", 41.2619, -95.8608),
    ("GCP", "us-west1", "Oregon", 45.5946, -121.1787),
    ("GCP", "us-west2", "Los Angeles", 34.0522, -118.2437),
    ("GCP", "us-west3", "Salt Lake City", 40.7608, -111.8910),
    ("GCP", "us-west4", "Las Vegas", 36.1699, -115.1398),
    ("GCP", "us-south1", "Dallas", 32.7767, -96.7970),
]

#: Boxes of the states: south, west, north, east.  Where boxes overlap the first counts.
STATE_BOXES = {
    "AL": (30.14, -88.47, 35.00, -84.89),
    "AZ": (31.33, -114.82, 37.00, -109.05),
    "AR": (33.00, -94.62, 36.50, -89.64),
    "CA": (32.53, -124.41, 42.01, -114.13),
    "CO": (36.99, -109.06, 41.00, -102.04),
    "CT": (40.99, -73.73, 42.05, -71.79),
    "DE": (38.45, -75.79, 39.84, -75.05),
    "FL": (24.52, -87.63, 31.00, -80.03),
    "GA": (30.36, -85.61, 35.00, -80.84),
    "ID": (41.99, -117.24, 49.00, -111.04),
    "IL": (36.97, -91.51, 42.51, -87.02),
    "IN": (37.77, -88.10, 41.76, -84.78),
    "IA": (40.37, -96.64, 43.50, -90.14),
    "KS": (36.99, -102.05, 40.00, -94.59),
    "KY": (36.50, -89.57, 39.15, -81.96),
    "LA": (28.93, -94.04, 33.02, -88.82),
    "ME": (43.06, -71.08, 47.46, -66.95),
    "MD": (37.91, -79.49, 39.72, -74.98),
    "MA": (41.24, -73.51, 42.89, -69.93),
    "MI": (41.70, -90.42, 48.31, -82.42),
    "MN": (43.50, -97.24, 49.38, -89.49),
    "MS": (30.17, -91.65, 35.01, -88.10),
    "MO": (35.99, -95.77, 40.61, -89.10),
    "MT": (44.35, -116.05, 49.00, -104.04),
    "NE": (39.99, -104.05, 43.00, -95.31),
    "NV": (35.00, -120.01, 42.00, -114.03),
    "NH": (42.70, -72.56, 45.31, -70.61),
    "NJ": (38.93, -75.56, 41.36, -73.89),
    "NM": (31.33, -109.05, 37.00, -103.00),
    "NY": (40.50, -79.76, 45.01, -71.86),
    "NC": (33.84, -84.32, 36.59, -75.46),
    "ND": (45.94, -104.05, 49.00, -96.55),
    "OH": (38.40, -84.82, 42.33, -80.52),
    "OK": (33.62, -103.00, 37.00, -94.43),
    "OR": (41.99, -124.57, 46.24, -116.46),
    "PA": (39.72, -80.52, 42.27, -74.69),
    "RI": (41.15, -71.91, 42.02, -71.12),
    "SC": (32.04, -83.35, 35.21, -78.54),
    "SD": (42.48, -104.06, 45.95, -96.44),
    "TN": (34.98, -90.31, 36.68, -81.65),
    "TX": (25.84, -106.65, 36.50, -93.51),
    "UT": (36.99, -114.05, 42.00, -109.04),
    "VT": (42.73, -73.44, 45.02, -71.50),
    "VA": (36.54, -83.68, 39.47, -75.24),
    "WA": (45.54, -124.76, 49.00, -116.92),
    "WV": (37.20, -82.64, 40.64, -77.72),
    "WI": (42.49, -92.89, 47.08, -86.25),
    "WY": (40.99, -111.06, 45.01, -104.05),
    "DC": (38.79, -77.12, 38.99, -76.91),
}
