"""Input tables and the fixture network derived from them."""
