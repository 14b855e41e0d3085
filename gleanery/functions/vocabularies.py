"""Vocabularies of the zero-shot labels: label and the prompt that a text encoder embeds."""

from __future__ import annotations

#: Labels and prompts of categories, in order.
CATEGORIES = {
    "nature": "a photo of a natural landscape with mountains, forests, oceans, or rivers",
    "space": "a photo of outer space showing galaxies, stars, planets, or nebulae",
    "animals": "a photo featuring animals, wildlife, birds, or creatures in their habitat",
    "underwater": "an underwater photo of the ocean depths, marine life, or coral reefs",
    "aerial": "an aerial view photo taken from a drone or bird's eye perspective",
    "mountains": "towering mountain peaks with snow caps, alpine valleys, dramatic ridgelines",
    "beach": "sandy beach shoreline with ocean waves, palm trees, coastal sunset",
    "forest": "dense woodland with tall trees, forest path, dappled sunlight through canopy",
    "desert": "arid sand dunes, barren desert landscape, cacti, dry cracked earth",
    "ocean": "vast open ocean seascape, rolling waves, deep blue water horizon",
    "urban": "a photo of a city skyline, urban street, or metropolitan architecture",
    "architecture": "a photo focusing on modern building design, structures, or geometry",
    "automotive": "a photo of cars, motorcycles, or vehicles in a cinematic style",
    "abstract": "an abstract image with geometric patterns, shapes, or non-representational designs",
    "minimalist": "a minimalist image with simple composition and negative space",
    "art": "a piece of digital art, illustration, painting, or concept art",
    "anime": "an anime or manga style illustration with japanese animation aesthetics",
    "vintage": "photo with Kodak film grain texture, 1970s faded color grading, light leaks, and analog camera vignetting",
    "macro": "extreme close-up macro photography of tiny subjects, insects, water droplets, textures",
    "portrait": "portrait photography with shallow depth of field, face or figure as subject",
    "long_exposure": "long exposure photography with light trails, smooth water, star trails, motion blur",
    "bokeh": "dreamy bokeh background with circular blurred lights, shallow depth of field",
    "technology": "a futuristic image with cyberpunk, neon, or sci-fi technology themes",
    "gaming": "a video game screenshot or gaming-related digital artwork",
    "dark": "a dark, low-key image suitable for AMOLED screens with black backgrounds",
    "colorful": "a vibrant, highly saturated image with bright rainbow colors",
    "fantasy": "magical fantasy scene with dragons, castles, wizards, mythical creatures",
    "horror": "dark eerie horror aesthetic, haunted atmosphere, creepy shadows, fog",
    "romantic": "romantic dreamy scene, couples silhouette, sunset, roses, soft lighting",
    "sports": "dynamic sports action photography, athletes in motion, stadium, competition",
    "japanese": "japanese aesthetic with cherry blossoms, torii gates, temples, zen gardens",
    "european": "european architecture, cobblestone streets, historic buildings, cathedrals",
    "tropical": "lush tropical paradise with palm trees, exotic flowers, turquoise water",
    "nordic": "scandinavian nordic landscape, fjords, aurora borealis, snow, pine forests",
    "neon": "neon lights and signs glowing in darkness, vibrant electric colors",
    "gradient": "smooth color gradient background, soft color transitions, abstract blend",
    "3d_render": "3D rendered digital art, CGI scene, geometric shapes, modern 3D graphics",
    "vector": "flat vector art illustration, clean lines, bold shapes, graphic design style",
    "seasonal": "a seasonal image showing spring, summer, autumn leaves, or winter snow",
    "weather": "a photo featuring weather elements like rain, storms, lightning, or clouds",
}

#: Labels and prompts of moods, in order.
MOODS = {
    "calm": "a serene still lake at dawn with soft pastel sky reflections and gentle mist",
    "dramatic": "stormy sky with dark clouds, dramatic chiaroscuro lighting, high contrast shadows",
    "mysterious": "misty foggy forest with obscured paths, dim twilight, silhouettes in haze",
    "energetic": "explosive colorful abstract with dynamic motion blur, flying particles, vibrant streaks",
    "romantic": "soft bokeh sunset with warm golden pink hues, cherry blossoms, dreamy soft focus",
    "melancholic": "lonely figure in rain, desaturated muted tones, overcast grey sky, empty landscapes",
    "inspiring": "golden sunrise breaking through mountain peaks, rays of light through clouds",
    "cozy": "warm fireplace glow, cabin interior with soft warm lighting, autumn leaves",
    "epic": "vast cinematic wide-angle landscape with towering mountains, god rays through dramatic storm clouds at golden hour",
    "surreal": "impossible architecture, melting clocks, floating objects, dreamlike impossible physics",
    "serene": "zen garden with raked sand, still pond with koi fish, bamboo and minimalist stones",
    "nostalgic": "vintage polaroid aesthetic, faded family photos, old toys, warm sepia childhood memories",
    "adventurous": "winding mountain road, vast open horizons, explorer at cliff edge, untamed wilderness",
    "dark": "noir shadows, low-key lighting, silhouettes against dim light, moody atmospheric black",
    "whimsical": "fairy-tale mushroom forest, floating lanterns, magical creatures, enchanted playful fantasy",
    "futuristic": "sleek sci-fi architecture, holographic displays, floating vehicles, chrome and glass metropolis",
}

#: Labels and prompts of styles, in order.
STYLES = {
    "nord": "arctic frost palette with dark polar night #2e3440 background, aurora blue #5e81ac accents, snow white highlights",
    "gruvbox": "retro warm palette with dark ebony #282828 background, bright orange #d65d0e and cream yellow #fabd2f accents",
    "dracula": "dark purple #282a36 background with neon pink #ff79c6, cyan #8be9fd, and green #50fa7b accent colors",
    "monokai": "charcoal black #272822 background with bright orange #fd971f, yellow #e6db74, magenta #f92672 accents",
    "solarized": "blue-yellow balanced palette with teal #2aa198, orange #cb4b16, base16 background tones",
    "catppuccin": "muted mauve pink #cba6f7, lavender #b4befe, soft rosewater #f5e0dc on dark macchiato background",
    "cyberpunk": "neon city at night with hot pink, electric blue, purple neon glow against dark urban",
    "vaporwave": "1980s retro aesthetics with hot pink, cyan, palm trees, sunset gradient, grid floor",
    "minimalist": "clean single subject on solid background, extreme negative space, simple geometric shapes",
    "vintage": "faded film grain, sepia tones, cross-processed colors, light leaks, old photograph look",
    "natural": "forest greens, earthy browns, organic textures, moss, wood grain, natural lighting",
    "tokyo": "japanese neon-lit streets at night, kanji signs, rain-slicked pavement, anime aesthetic cityscape",
    "scandinavian": "clean nordic interior, white walls, hygge warmth, natural wood, minimalist cozy design",
    "brutalist": "raw exposed concrete architecture, stark geometric shapes, monolithic grey structures",
    "film_noir": "black and white high contrast, venetian blind shadows, detective aesthetic, cigarette smoke",
    "synthwave": "80s retro-futurism, neon pink and blue grid, chrome sun, digital landscape, outrun aesthetic",
    "cottagecore": "rustic countryside cottage, wildflower meadows, cozy farmhouse kitchen, floral patterns",
    "dark_academia": "old leather-bound library, classical architecture, candlelight, scholarly gothic aesthetic",
}

#: Labels and prompts of compositions, in order.
COMPOSITIONS = {
    "rule_of_thirds": "composition following rule of thirds with subject off-center",
    "centered": "centered composition with subject in the middle",
    "symmetrical": "symmetrical balanced mirrored composition",
    "leading_lines": "composition with leading lines guiding the eye",
    "diagonal": "dynamic diagonal composition with angular elements",
    "minimal": "minimal negative space simple composition",
}

#: Labels and prompts of the threshold classifier, in order.
CLASSIFIER_CATEGORIES = {
    "nature": "a landscape photo of mountains, forests, oceans, lakes, rivers, waterfalls, or natural scenery",
    "space": "a photo of galaxies, nebulae, stars, planets, aurora, or cosmic phenomena",
    "animals": "photos of animals, birds, wildlife, pets, or creatures in nature",
    "underwater": "underwater photography, ocean depths, marine life, coral reefs, or aquatic scenes",
    "aerial": "aerial views, drone photography, top-down perspectives, or bird's eye view landscapes",
    "urban": "a photo of city skylines, streets, urban landscapes, or metropolitan scenes",
    "architecture": "architectural photography, buildings, structures, bridges, or modern design",
    "automotive": "cars, motorcycles, vehicles, racing, or automotive photography",
    "abstract": "abstract art, geometric patterns, gradients, shapes, or non-representational designs",
    "minimalist": "minimalist design, simple clean aesthetics, negative space, or minimal compositions",
    "art": "digital art, illustration, painting, fantasy art, or artistic concept art",
    "anime": "anime art style, manga illustrations, or Japanese animation aesthetics",
    "vintage": "vintage aesthetics, retro style, old-fashioned, or nostalgic imagery",
    "technology": "cyberpunk, futuristic, sci-fi, neon, or technology-themed imagery",
    "gaming": "video game screenshots, gaming aesthetics, game-related artwork, or esports imagery",
    "dark": "dark themes, black backgrounds, AMOLED-friendly, or low-key photography",
    "colorful": "bright vibrant colors, vivid imagery, rainbow colors, or highly saturated photos",
    "seasonal": "seasonal imagery, spring blossoms, autumn leaves, winter snow, or summer scenes",
    "weather": "weather phenomena, rain, storms, clouds, lightning, or atmospheric conditions",
    "sports": "sports photography, athletics, action sports, or sporting events",
    "food": "food photography, culinary art, dishes, or gastronomic imagery",
    "fantasy": "fantasy worlds, magical themes, mythical creatures, or imaginative landscapes",
}

#: Factors for labels that match too much.
PENALTIES = {
    "epic": 0.65,
    "inspiring": 0.75,
    "mysterious": 0.8,
    "dracula": 0.55,
    "catppuccin": 0.55,
    "monokai": 0.65,
}
