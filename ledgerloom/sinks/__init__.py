"""Writers: appended, replaced and exported tables."""
