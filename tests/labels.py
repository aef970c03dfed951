"""The labels of the navigation status, by code."""

STATUS_LABELS = (
    "Under way using engine",
    "At anchor",
    "Not under command",
    "Restricted maneuverability",
    "Constrained by her draught",
    "Moored",
    "Aground",
    "Engaged in Fishing",
    "Under way sailing",
    "Reserved for future amendment of Navigational Status for HSC",
    "Reserved for future amendment of Navigational Status for WIG",
    "Reserved for future use",
    "Reserved for future use",
    "Reserved for future use",
    "AIS-SART is active",
    None,
)
