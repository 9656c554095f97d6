"""Writers. These act: everything before them is lazy."""
