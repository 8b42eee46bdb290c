"""A small corpus that several test files share."""

DOCS = [
    (1, "The cat sat on the mat. The cat's hat was red."),
    (2, "A red car and a red bus."),
    (3, "Cats and cars: the cat drives a car, a red car!"),
    (4, ""),
    (5, "the of and to"),
    (6, "Bus stops near www.example.com and near the mat"),
    (7, "cat cat cat cat"),
]
