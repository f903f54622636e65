"""Writers for the three layers and the records they leave about each write."""
